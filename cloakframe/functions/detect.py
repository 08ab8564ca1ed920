"""Findings in text: patterns, context, word lists; overlaps; replacement; JSON walks.

Pure Python, imported by the Arrow UDFs of operators.scan; compiled once in a worker.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

from ..model import LEAST_SCORE, LEAST_SCORES, entities_of
from . import patterns as P

#: Tokens before a match that count as its context; what a context word adds, and to what.
LOOK_BACK, LIFT, LIFTED = 6, 0.35, 0.4
TOKEN = re.compile(r"[A-Z][A-Z0-9_]*_\d+")
_WORD = re.compile(r"[^\W\d_]+", re.U)
_DIGIT = re.compile(r"\d")
Finding = tuple[str, int, int, float]


def within_edits(a: str, b: str, most: int) -> bool:
    """Whether ``a`` becomes ``b`` by ``most`` single-letter edits."""
    if abs(len(a) - len(b)) > most:
        return False
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        if min(row) > most:
            return False
    return row[-1] <= most


@lru_cache(maxsize=1)
def _recognizers() -> list[P.Recognizer]:
    return P.recognizers()


@lru_cache(maxsize=1)
def _context() -> dict[str, frozenset[str]]:
    return {e: frozenset(w.split()) for e, w in P.CONTEXT.items()}


@lru_cache(maxsize=50_000)
def _context_word(entity: str, word: str) -> bool:
    words = _context().get(entity, frozenset())
    return word in words or len(word) >= 5 and any(len(w) >= 5 and within_edits(word, w, 1) for w in words)


def _shortened(word: str, most: int) -> set[str]:
    """The word and what is left of it without up to ``most`` letters."""
    out, last = {word}, {word}
    for _ in range(most):
        last = {w[:i] + w[i + 1 :] for w in last for i in range(len(w))}
        out |= last
    return out


#: Letters of the longest seed.
LONGEST = max(len(w) for words in P.CONCEPTS.values() for w in " ".join(words).split())


@lru_cache(maxsize=1)
def _seeds() -> tuple[dict[str, str], dict[str, tuple[str, ...]]]:
    """{seed: entity}, and {shortened seed: seeds} of those long enough to be misspelt."""
    exact: dict[str, str] = {}
    for entity, words in P.CONCEPTS.items():
        for w in " ".join(words).split():
            exact.setdefault(w, entity)
    near: dict[str, tuple[str, ...]] = {}
    for w in exact:
        if len(w) >= 5:
            for x in _shortened(w, 2):
                near[x] = (*near.get(x, ()), w)
    return exact, near


@lru_cache(maxsize=200_000)
def concept_of(word: str) -> str | None:
    """The special category of a word: a seed, or one within 2 edits (1 under 6 letters);
    short acronyms only as they are."""
    exact, near = _seeds()
    if word in exact or not 5 <= len(word) <= LONGEST + 2:
        return exact.get(word)
    most = 2 if len(word) >= 6 else 1
    found = {s for x in _shortened(word, most) for s in near.get(x, ())}
    return next((exact[s] for s in exact if s in found and within_edits(word, s, most)), None)


def analyze(text: str, entities: frozenset[str] | None = None) -> list[Finding]:
    """All findings whose score reaches the entity's least, overlapping or not."""
    wanted = frozenset(entities_of()) if entities is None else entities
    out = []
    numbers = _DIGIT.search(text) is not None
    # beyond ASCII a letter can match one that it is not the upper case of
    lower = text.lower() if text.isascii() else None
    for r in _recognizers():
        if r.entity not in wanted and r.entity != "US_BANK_NUMBER" or r.digits and not numbers:
            continue
        if r.pieces and lower is not None and not any(p in lower for p in r.pieces):
            continue
        for m in r.regex.finditer(text):
            score, end = r.score, m.end()
            if r.valid is not None:
                said = m[0]
                while not r.valid(said) and said:
                    said = said.rpartition(" ")[0] if r.words else ""
                if not said:
                    continue
                end = m.start() + len(said)
                score = 1.0 if r.sure else score
            if score < LIFTED and r.entity in P.CONTEXT:
                before = _WORD.findall(text[max(0, m.start() - 120) : end].lower())
                if any(_context_word(r.entity, w) for w in before[-LOOK_BACK - 2 :]):
                    score = max(score + LIFT, LIFTED)
            if score >= LEAST_SCORES.get(r.entity, LEAST_SCORE):
                out.append((r.entity, m.start(), end, score))
    told = {w: e for w in set(_WORD.findall(text)) if (e := concept_of(w.lower())) and e in wanted}
    for m in _WORD.finditer(text) if told else ():
        if m[0] in told:
            out.append((told[m[0]], m.start(), m.end(), P.CONCEPT_SCORE))
    return out


def resolve(found: list[Finding]) -> list[Finding]:
    """Without overlaps: higher score first, then wider, then earlier; in order of start.
    Spans that only touch both stay."""
    kept: list[Finding] = []
    for f in sorted(found, key=lambda x: (-x[3], x[1] - x[2], x[1])):
        if all(f[2] <= k[1] or k[2] <= f[1] for k in kept):
            kept.append(f)
    return sorted(kept, key=lambda x: x[1])


def is_token(text: str) -> bool:
    return TOKEN.fullmatch(text.strip()) is not None


def parse_document(text: str) -> dict | list | None:
    """The object or array that the string is; None for anything else."""
    if not text.lstrip()[:1] in ("{", "["):
        return None
    try:
        got = json.loads(text)
    except ValueError:
        return None
    return got if isinstance(got, (dict, list)) else None


def strings(value, path: str = "$", keys: bool = True) -> Iterator[tuple[str, str]]:
    """(path, string) of all strings in a document, keys too; a key's own path ends in <key>."""
    if isinstance(value, str):
        yield path, value
    elif isinstance(value, list):
        for i, x in enumerate(value):
            yield from strings(x, f"{path}[{i}]", keys)
    elif isinstance(value, dict):
        for k, x in value.items():
            safe = k if re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]{0,63}", k) and not RESIDUAL["EMAIL_ADDRESS"].search(k) else "<key>"
            if keys:
                yield f"{path}.<key>", k
            yield from strings(x, f"{path}.{safe}", keys)


def mapped(value, change: Callable[[str], str]):
    """The document with every key and string changed; the rest as it is."""
    if isinstance(value, str):
        return change(value)
    if isinstance(value, list):
        return [mapped(x, change) for x in value]
    if isinstance(value, dict):
        return {change(k): mapped(x, change) for k, x in value.items()}
    return value


def masked(text: str, token: Callable[[str, str], str], found: Callable[[str], list[Finding]]) -> str:
    """The text, or every string of the document it is, with tokens for its findings."""
    def change(s: str) -> str:
        if is_token(s):
            return s
        for entity, start, end, _ in reversed(found(s)):
            s = s[:start] + token(entity, s[start:end]) + s[end:]
        return s

    document = parse_document(text)
    return change(text) if document is None else json.dumps(mapped(document, change), ensure_ascii=False)


# Patterns of the residual scan.
RESIDUAL = {
    "EMAIL_ADDRESS": re.compile(r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b"),
    "URL": re.compile(r"\b(?:https?://|www\.)[^\s<>'\"]+", re.I),
    "IBAN_CODE": re.compile(r"\b[A-Z]{2}\d{2}[A-Z0-9]{11,30}\b", re.I),
    "CREDIT_CARD": re.compile(r"\b(?:\d[ -]?){13,19}\b"),
    "PHONE_NUMBER": re.compile(r"(?<!\w)(?:\+?\d[\d .()/-]{6,}\d)(?!\w)"),
    "IP_ADDRESS": re.compile(r"\b(?:[0-9A-Fa-f:.]{3,})\b"),
}
