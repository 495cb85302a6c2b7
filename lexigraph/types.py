"""Schemas of the data model, and the settings of its operators."""

from __future__ import annotations

from dataclasses import dataclass, replace

ENTITY = "struct<name:string,entity_type:string>"
SPAN = "struct<start:int,end:int,text:string>"
TRIPLE = f"seq bigint, subject {ENTITY}, predicate string, object {ENTITY}, confidence double, source_doc_id string, source_span {SPAN}, inferred boolean"
NODE = "name string, entity_type string, last_seen_doc string"
EDGE = "subject string, predicate string, object string, confidence double, source_doc_id string, inferred boolean"
RULE = "subject_type string, predicate string, object_type string"
CHUNK = "doc_id string, index int, text string, start int, end int"
STATE = "doc_id string, checksum string, modified_at double"
EVENT = "doc_id string, kind string, path string, checksum string, modified_at double"

CONCEPT = "CONCEPT"
INFERRED_DOC = "__inference__"


@dataclass(frozen=True)
class ChunkConfig:
    max_chars: int = 1200
    overlap_chars: int = 120
    min_chunk_chars: int = 200

    def __post_init__(self) -> None:
        if self.max_chars <= 0 or self.overlap_chars < 0 or self.min_chunk_chars < 0:
            raise ValueError("chunk sizes must be positive")
        if self.overlap_chars >= self.max_chars:
            raise ValueError("overlap_chars must be less than max_chars")


@dataclass(frozen=True)
class ExtractionConfig:
    min_confidence: float = 0.0
    max_retries: int = 2
    batch_size: int = 8
    batch_token_budget: int = 6000
    require_citations: bool = False

    def __post_init__(self) -> None:
        if not 0 <= self.min_confidence <= 1:
            raise ValueError("min_confidence must be from 0 to 1")
        if self.max_retries < 0 or self.batch_size < 1 or self.batch_token_budget < 1:
            raise ValueError("max_retries, batch_size and batch_token_budget must be positive")

    def override(self, **changes) -> ExtractionConfig:
        return replace(self, **changes)


@dataclass(frozen=True)
class LoadConfig:
    batch_size: int = 500
    max_retries: int = 2

    def __post_init__(self) -> None:
        if self.batch_size < 1 or self.max_retries < 0:
            raise ValueError("batch_size must be positive and max_retries not negative")


@dataclass(frozen=True)
class BridgeConfig:
    floor: float = 0.55
    cap: float = 0.95
    candidate_limit: int = 25
    max_components: int = 50


@dataclass(frozen=True)
class ResolveConfig:
    threshold: float = 0.85
    review_floor: float = 0.7
    dimensions: int = 256
    ngram: int = 3
