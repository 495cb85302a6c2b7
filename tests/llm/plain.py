"""Plain-Python versions of operators, for small tables."""

import re

BASE = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
    ("iban", r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}\b"),
    ("ssn", r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b"),
    ("secret", r"\b[A-Za-z0-9_][A-Za-z0-9_-]{15,}"),
]
NEAR = {
    "email": r"\b(?:e-?mail|contact|mailto)\b",
    "ip": r"\b(?:ip|host|server|address)\b",
    "card": r"\b(?:card|visa|credit|debit|payment)\b",
    "phone": r"\b(?:phone|tel|call|mobile|fax)\b",
    "iban": r"\b(?:iban|bank|account|konto)\b",
    "ssn": r"\b(?:ssn|social security)\b",
    "secret": r"(?:password|passwd|secret|token|api_?key|bearer)",
}


def _luhn(d):
    total = 0
    for i, c in enumerate(reversed(d)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _good(kind, m):
    d = re.sub("[^0-9]", "", m)
    if kind == "ip":
        return all(int(p) <= 255 for p in m.split("."))
    if kind == "card":
        return 14 <= len(d) <= 19 and _luhn(d)
    if kind == "phone":
        return 10 <= len(d) <= 15
    if kind == "iban":
        s = m.replace(" ", "")
        s = s[4:] + s[:4]
        return 15 <= len(s) <= 34 and int("".join(str(int(c, 36)) for c in s)) % 97 == 1
    if kind == "secret":
        return bool(re.search("[0-9]", m) and re.search("[A-Za-z]", m))
    return True


def spans(text):
    """(start, kind, end, score) by start, then kind."""
    out = []
    for rank, (kind, p) in enumerate(BASE):
        for m in re.finditer(p, text or "", re.A):
            if not _good(kind, m[0]):
                continue
            near = re.search("(?i)" + NEAR[kind], text[max(0, m.start() - 40) : m.start()], re.A)
            score = 0.4 + 0.3 * (kind in ("card", "iban")) + 0.3 * bool(near)
            if rank < 4 or score >= 0.6 - 1e-9:
                out.append((m.start(), rank, kind, m.end(), score))
    return [(s, k, e, x) for s, _, k, e, x in sorted(out)]


def redacted(text):
    out, at = "", 0
    for s, k, e, _ in spans(text):
        if s >= at:
            out += text[at:s] + f"[{k}]"
        at = max(at, e)
    return out + text[at:]


def components(rows, percent):
    sets = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets.setdefault(i, []).append({tuple(w[j : j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    ids = [i for i in sets if i is not None]
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in ids:
        for b in ids:
            if a < b and any(x and y and 100 * len(x & y) >= percent * len(x | y) for x in sets[a] for y in sets[b]):
                p, q = sorted((find(a), find(b)))
                parent[q] = p
    return {i: find(i) for i in ids}


def without_repeats(rows, length=50):
    """[(doc_id, bytes that stay, which bytes go)] of (doc_id, text)."""
    first = {}
    for i, t in rows:
        b = (t or "").encode()
        for j in range(len(b) - length + 1 if i is not None else 0):
            first[b[j : j + length]] = min(first.get(b[j : j + length], i), i)
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = [False] * len(b)
        for j in range(len(b) - length + 1 if i is not None else 0):
            if first[b[j : j + length]] < i:
                gone[j : j + length] = [True] * length
        out.append((i, bytes(x for x, g in zip(b, gone) if not g), gone))
    return out


def measures(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(i, i + 3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered)


def em(votes, prior=0.9, smooth=1.0, trust=(0.3, 3.5), rounds=100):
    """The posterior of good for each document, document by document."""
    from math import exp, log

    post = [1 / (1 + exp(-trust[0] * v.count("+") + trust[1] * v.count("-") - log(prior / (1 - prior)))) for v in votes]
    for _ in range(rounds):
        share = [sum(1 - p for p in post) / len(post), sum(post) / len(post)]
        like = []
        for c in (0, 1):
            for j in range(len(votes[0])):
                n = {"-": (2.0, 1.0)[c] * smooth, "0": smooth, "+": (1.0, 2.0)[c] * smooth}
                for v, p in zip(votes, post):
                    n[v[j]] += p if c else 1 - p
                like.append({k: x / sum(n.values()) for k, x in n.items()})
        half = len(votes[0])
        new = []
        for v in votes:
            s = [log(min(1, max(1e-6, share[c]))) + sum(log(like[c * half + j][x]) for j, x in enumerate(v)) for c in (0, 1)]
            new.append(1 / (1 + exp(min(500, max(-500, s[0] - s[1])))))
        done = max(abs(a - b) for a, b in zip(new, post)) < 1e-9
        if done:
            break
        post = new
    return post
