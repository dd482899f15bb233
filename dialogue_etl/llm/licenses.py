"""License scans: Aho-Corasick finds identifier tags and notice phrases, a shunting-yard parser evaluates expressions.

The alphabet is words. Most words occur in no phrase, so the automaton only reads the runs of words that do. An
identifier tag is followed by an expression of identifiers with and, or, with and brackets; notices that a text joins
by one of these words are an expression too. Expressions are evaluated to the identifiers that they name and to a
degree of freedom: or takes the freer side, and the less free one, with an exception comes half-way to full freedom.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialogue_etl.llm.textkit import ALNUM, FOLD, Vocabulary, slices, word_spans

# Phrases with their labels, tags, and the freedom of a licence by the start of its identifier.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
NOTICES = {
    "affero general public license": "agpl", "lesser general public license": "lgpl", "library general public license": "lgpl", "gpl license": "gpl",
    "mit license": "mit", "apache license": "apache", "apache software license": "apache", "bsd license": "bsd", "isc license": "isc", "zlib license": "zlib",
    "boost software license": "bsl", "mozilla public license": "mpl", "eclipse public license": "epl", "european union public licence": "eupl",
    "cc by sa": "cc-by-sa", "cc by nc": "cc-by-nc", "cc by nd": "cc-by-nd", "cc by nc sa": "cc-by-nc-sa", "cc by nc nd": "cc-by-nc-nd",
    "creative commons attribution": "cc-by", "creative commons attribution sharealike": "cc-by-sa", "creative commons attribution noncommercial": "cc-by-nc",
    "creative commons zero": "cc0", "cc0 1 0": "cc0", "public domain": "public-domain", "no rights reserved": "public-domain",
}
TAGS = ("spdx license identifier", "license expression", "license identifier")
FREEDOM = {
    "0bsd": 1.0, "agpl": 0.4, "apache": 0.9, "bsd": 0.9, "bsl": 0.9, "cc-by": 0.8, "cc-by-nc": 0.2, "cc-by-nd": 0.2, "cc-by-sa": 0.6, "cc0": 1.0, "epl": 0.6, "eupl": 0.6,
    "gpl": 0.5, "isc": 0.9, "lgpl": 0.6, "mit": 0.9, "mpl": 0.6, "public-domain": 1.0, "reserved": 0.0, "unlicense": 1.0, "zlib": 0.9,
}
#: Freedom of an identifier that the list doesn't have.
UNKNOWN = 0.5
#: Notices at most this many words apart are joined by and, or, with.
GAP = 6

_RANK = {"or": 1, "and": 2, "with": 3}
_TOKEN = re.compile(r"[ \t]*([()]|[A-Za-z0-9](?:[A-Za-z0-9.+:_-]*[A-Za-z0-9+])?)")
_OPENING = re.compile(r"[ \t]*[:=][ \t]*[\"'`]?")


def freedom(name: str) -> float:
    """By the longest listed start of the identifier that ends at a hyphen or at its end."""
    parts = name.split("-")
    return next((FREEDOM[p] for p in ("-".join(parts[:k]) for k in range(len(parts), 0, -1)) if p in FREEDOM), UNKNOWN)


class Value(NamedTuple):
    """What an expression stands for: its tokens in postfix order, the identifiers that it names, its freedom, and the
    number of tokens that were read for it."""

    postfix: list[str]
    names: set[str]
    free: float
    read: int


def evaluate(tokens: Iterator[str]) -> Value | None:
    """The value of the longest expression that the tokens start with, None if they start with none.

    Identifiers are operands; and, or, with are operators, with binding strongest and or weakest, equal ones from
    the left; an operator without a right side is left out, a bracket that isn't closed ends with the expression.
    """
    postfix: list[str] = []
    names: set[str] = set()
    free: list[float] = []
    waiting: list[str] = []

    def release(rank: int) -> None:
        while waiting and _RANK.get(waiting[-1], 0) >= max(1, rank):
            op = waiting.pop()
            right, left = free.pop(), free.pop()
            free.append((left + 1) / 2 if op == "with" else max(left, right) if op == "or" else min(left, right))
            postfix.append(op)

    open_brackets, wants_operand, read = 0, True, 0
    for word in map(str.lower, tokens):
        exception = bool(waiting) and waiting[-1] == "with" and wants_operand
        if wants_operand and word == "(" and not exception:
            waiting.append(word)
            open_brackets += 1
        elif wants_operand and word not in _RANK and word not in ("(", ")"):
            postfix.append(word)
            free.append(freedom(word))
            if not exception:
                names.add(word)
            wants_operand = False
        elif not wants_operand and word in _RANK:
            release(_RANK[word])
            waiting.append(word)
            wants_operand = True
        elif not wants_operand and word == ")" and open_brackets:
            release(1)
            waiting.pop()
            open_brackets -= 1
        else:
            break
        read += 1
    while wants_operand and waiting:  # brackets without content, then the operator that lacks its right side
        if waiting.pop() in _RANK:
            break
    while waiting:
        release(1)
        if waiting:
            waiting.pop()
    return Value(postfix, names, free[0], read) if free else None


def tokens_of(text: str, at: int = 0) -> Iterator[tuple[str, int]]:
    """Tokens of an expression and where they end, as far as there are any."""
    while m := _TOKEN.match(text, at):
        yield m[1], m.end()
        at = m.end()


@lru_cache(maxsize=8)
def _machine(phrases: tuple[tuple[str, str, str], ...]) -> tuple[Vocabulary, ahocorasick.Automaton, int]:
    """(words of phrases, automaton over their numbers, words of the shortest phrase); phrases are (phrase, kind, label)."""
    vocabulary = Vocabulary({w for phrase, _, _ in phrases for w in phrase.encode().split(b" ")})
    automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
    entries: dict[tuple[int, ...], list[tuple[str, str]]] = {}
    for phrase, kind, label in phrases:
        entries.setdefault(tuple(vocabulary.number[w] for w in phrase.encode().split(b" ")), []).append((kind, label))
    for key, found in entries.items():
        automaton.add_word(key, (len(key), found))
    automaton.make_automaton()
    return vocabulary, automaton, min(map(len, entries))


def _places(phrases, data: np.ndarray, starts: np.ndarray, stops: np.ndarray, first: np.ndarray) -> dict[int, list[tuple[int, int, str, str]]]:
    """By text: (first word, words, kind, label) of every place of a phrase, words counted over all texts."""
    vocabulary, automaton, least = _machine(phrases)
    at, term = vocabulary.find(data, starts, stops)
    doc = np.searchsorted(first, at, "right") - 1
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1] + 1) | (doc[1:] != doc[:-1])
    begin = np.flatnonzero(new)
    size = np.diff(np.append(begin, len(at)))
    found: dict[int, list[tuple[int, int, str, str]]] = {}
    for b, n in zip(begin[size >= least].tolist(), size[size >= least].tolist()):
        for end, (words, entries) in automaton.iter(tuple(term[b : b + n].tolist())):
            start = int(at[b]) + end - words + 1
            found.setdefault(int(doc[b]), []).extend((start, words, kind, label) for kind, label in entries)
    return found


def _joined(notices: list[tuple[int, int, str]], data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> Iterator[list[str]]:
    """Expressions of notices (first word, words, label): neighbours that and, or, with join; others stand alone."""
    tokens: list[str] = []
    end = 0
    for start, words, label in notices:
        gap = [FOLD[data[starts[k] : stops[k]]].tobytes().decode(errors="replace") for k in range(end, start)] if tokens and start - end <= GAP else []
        ops = [w for w in gap if w in _RANK]
        if tokens and ops:
            tokens += [ops[-1], label]
        else:
            if tokens:
                yield tokens
            tokens = [label]
        end = start + words
    if tokens:
        yield tokens


def _scan(phrases):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, z, data, ends in slices(batch.column(1)):
                starts, stops, first = word_spans(data, ends, ALNUM)
                found = _places(phrases, data, starts, stops, first)
                lines = np.flatnonzero(data == 10)
                rows = [_read(sorted(found[k]), data, starts, stops, lines, int(first[k]), int(ends[k + 1])) if k in found else _NOTHING for k in range(z - a)]
                columns = [pa.array(c, t) for c, t in zip(zip(*rows), _TYPES)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, z - a), pa.array(np.diff(first), pa.int64()), *columns], names=_NAMES)

    return run


_NAMES = ["id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "places", "expressions"]
_PLACE = pa.struct([("word", pa.int64()), ("n_words", pa.int32()), ("label", pa.string())])
_TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.string()), pa.float64(), pa.list_(_PLACE), pa.list_(pa.string())]
_NOTHING = (0, None, None, [], [], 0.0, [], [])
_SCHEMA = "id {id}, n_words long, n_base long, first_word long, last_word long, base_labels array<string>, labels array<string>, score double, places array<struct<word:long,n_words:int,label:string>>, expressions array<string>"


def _read(places: list[tuple[int, int, str, str]], data: np.ndarray, starts: np.ndarray, stops: np.ndarray, lines: np.ndarray, first: int, end: int) -> tuple:
    """One text's row from its places; lines are the places of line ends, first is its first word, end its last byte + 1."""
    base = [(w, label) for w, _, kind, label in places if kind == "base"]
    labels = {label for _, _, kind, label in places if kind != "tag"}
    stated: list[Value] = []
    read: list[tuple[int, int]] = []  # bytes of expressions after tags
    tags: list[tuple[int, int]] = []  # first and last words; a shorter tag inside a longer one is the same tag
    for start, words, kind, _ in places:
        if kind == "tag" and (not tags or start > tags[-1][1]):
            tags.append((start, start + words - 1))
    for k, (_, last) in enumerate(tags):
        # An expression ends with its line, and before the next tag.
        begin, stop = int(stops[last]), int(starts[tags[k + 1][0]]) if k + 1 < len(tags) else end
        line = lines[np.searchsorted(lines, begin)] if len(lines) and lines[-1] >= begin else end
        rest = data[begin : min(stop, line)].tobytes().decode(errors="replace")
        opening = _OPENING.match(rest)
        found = list(tokens_of(rest, opening.end())) if opening else []
        value = evaluate(token for token, _ in found)
        if value:
            stated.append(value)
            read.append((begin, begin + len(rest[: found[value.read - 1][1]].encode())))
    # Of notices that overlap the longest counts, the earlier of equal ones.
    notices: list[tuple[int, int, str]] = []
    for start, words, kind, label in sorted((p for p in places if p[2] != "tag"), key=lambda p: (p[0], -p[1], p[3])):
        k = bisect_right(read, (int(starts[start]), end)) - 1
        if k >= 0 and read[k][0] <= starts[start] < read[k][1]:
            continue
        if notices and start < notices[-1][0] + notices[-1][1]:
            if words > notices[-1][1]:
                notices[-1] = (start, words, label)
            continue
        notices.append((start, words, label))
    stated += [v for v in map(evaluate, map(iter, _joined(notices, data, starts, stops))) if v]
    labels.update(n for v in stated for n in v.names)
    score = min((v.free for v in stated), default=0.0)
    words_of = [w - first for w, _ in base]
    return (
        len(base), min(words_of, default=None), max(words_of, default=None), sorted({label for _, label in base}), sorted(labels), score,
        [{"word": w - first, "n_words": n, "label": label} for w, n, kind, label in places if kind != "tag"], [" ".join(v.postfix) for v in stated],
    )


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", base: dict[str, str] | None = None, notices: dict[str, str] | None = None, tags: tuple[str, ...] = TAGS) -> DataFrame:
    """Returns for every row of docs: id, n_words, n_base (places of base phrases), first_word and last_word (their
    smallest and largest start, null without any), base_labels and labels (sorted arrays), score, places (word,
    n_words, label of every phrase) and expressions (their tokens in postfix order).

    Words are runs of ASCII letters and digits and of any other character beyond ASCII, A-Z folded. The score is the
    freedom that all statements of the text leave together, the least of theirs: 1 for the public domain, 0 for all
    rights reserved and where nothing is stated. A phrase inside a longer one counts as a place and gives its label,
    but isn't a statement of its own, nor is one inside a tag's expression. A tag without ':' or '=' after it, or without an expression on its line, states nothing.

    Defined cases: null and empty texts have no words and state nothing; every row is read by itself, those that
    repeat an id and those without one too; long texts are read whole.
    """
    base, notices = BASE if base is None else base, NOTICES if notices is None else notices
    phrases = (*((p, "base", label) for p, label in base.items()), *((p, "notice", label) for p, label in notices.items()), *((p, "tag", "") for p in tags))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    found = rows.mapInArrow(_scan(phrases), _SCHEMA.format(id=rows.schema["id"].dataType.simpleString()))
    return found.withColumnRenamed("id", id_col)


def op13_license_scan(spark, sf_dir: str) -> DataFrame:
    """license_scan() of all documents. Null and empty texts have no words, no labels and the score 0; every row is
    read by itself."""
    found = license_scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base_labels", ",").alias("base_labels"), F.array_join("labels", ",").alias("labels"), "score")
