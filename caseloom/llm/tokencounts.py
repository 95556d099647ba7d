"""Exact token counts at every prefix of a text, by dynamic programming over byte-pair tokens.

The last token of a prefix is the one vocabulary entry that ends there and stands unmerged
beside the last token of the prefix before it, so one pass over a piece gives the exact count
at every place of it. Pieces (the tokenizer's own word-like parts) are independent, so a text's
counts are running sums over its pieces, each computed once. With the counts stored, how many
tokens any prefix has, and where a budget ends, are lookups.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The split pattern of byte-level tokenizers, and the white space it means.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LONG_SUFFIXES = ("'re", "'ve", "'ll")
#: Characters that every Unicode version of the last years puts into the same class. A text with
#: any other is split by the library itself, which is slower.
SETTLED = r"\u0000-՗ -⁯　-鿿가-힣＀-￯\U0001F300-\U0001F9FF"
#: Pieces whose counts a task keeps, and characters of a long text that are split at a time.
KEPT_PIECES = 400_000
SLICE_CHARS = 1_000_000
#: Prefixes whose counts one stored row holds.
PART_CHARS = 4_096


def _byte_names() -> dict[int, str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {**{b: chr(b) for b in plain}, **{b: chr(256 + k) for k, b in enumerate(others)}}


class PrefixCounts(dict):
    """Piece -> token counts of its prefixes (in code points, from none), filled when first met."""

    def __init__(self, tokenizer: str):
        super().__init__()
        settings = json.loads(tokenizer)
        split, model = settings["pre_tokenizer"] or {}, settings["model"]
        if (split.get("type") != "ByteLevel" or split.get("add_prefix_space") or not split.get("use_regex", True)
                or settings["normalizer"] or model["type"] != "BPE" or model.get("dropout")
                or model.get("ignore_merges") or model.get("end_of_word_suffix")
                or model.get("continuing_subword_prefix")):
            raise ValueError("only byte-level BPE without a normalizer is supported")
        marks = [t for t in settings["added_tokens"]]
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in marks):
            raise ValueError("added tokens that take white space or whole words are not supported")
        self.library = Tokenizer.from_str(tokenizer)
        self.names = _byte_names()
        self.tokens = ["", *model["vocab"]]
        if not set(self.names.values()) <= set(self.tokens):
            raise ValueError("some bytes have no token")
        self.ends = ahocorasick.Automaton()
        for number, token in enumerate(self.tokens[1:], 1):
            self.ends.add_word(token, (number, len(token)))
        self.ends.make_automaton()
        self.beside: dict[int, bool] = {}
        self.pieces_of = regex.compile(PIECES).findall
        self.odd = regex.compile(f"[^{SETTLED}]").search
        self.cut = regex.compile(r"(?<=\S) (?=\S)").search
        self.blanks = regex.compile(r"\s+").finditer
        longest_first = sorted((t["content"] for t in marks), key=len, reverse=True)
        self.marks = regex.compile("|".join(map(regex.escape, longest_first)) or r"(?!)")

    def stands(self, before: int, token: int) -> bool:
        """Whether the encoding of both keeps the token apart from the one before (0: nothing)."""
        if len(self.beside) >= 4 * KEPT_PIECES:
            self.beside.clear()
        parts = [t.value for t in self.library.model.tokenize(self.tokens[before] + self.tokens[token])]
        found = parts == ([self.tokens[before], self.tokens[token]] if before else [self.tokens[token]])
        self.beside[before * len(self.tokens) + token] = found
        return found

    def __missing__(self, piece: str):
        if len(self) >= KEPT_PIECES:
            self.clear()
        raw = piece.encode()
        # By last byte; the place -1 is the empty prefix.
        last, counts, done = [0] * (len(raw) + 1), [0] * (len(raw) + 1), 0
        known, n_tokens = self.beside.get, len(self.tokens)
        for end, (token, length) in self.ends.iter(raw.decode("latin-1").translate(self.names)):
            if end == done:
                before = last[end - length]
                stands = known(before * n_tokens + token)
                if self.stands(before, token) if stands is None else stands:
                    last[end], counts[end] = token, counts[end - length] + 1
                    done += 1
        ends = counts[:-1] if len(raw) == len(piece) else [
            n for n, following in zip(counts, [*raw[1:], 0]) if following & 0xC0 != 0x80]
        found = bytes([0, *ends]) if max(ends) < 256 else np.array([0, *ends], np.int64)
        self[piece] = found
        return found

    def pieces(self, text: str) -> list[str]:
        if self.odd(text):
            return [text[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(text)]
        return self.pieces_of(text)

    def slices(self, text: str) -> Iterator[str]:
        """A long text in parts that are cut where a piece starts in any case."""
        start = 0
        while len(text) - start > SLICE_CHARS:
            found = self.cut(text, start + SLICE_CHARS)
            if not found:
                break
            yield text[start:found.start()]
            start = found.start()
        yield text[start:]

    def measured(self, text: str, budget: int) -> tuple[int, int]:
        """Tokens of the text, and code points of its longest prefix of at most ``budget`` tokens."""
        if self.marks.search(text):
            counts = np.concatenate(list(self.counts(text)))
            return int(counts[-1]), int(np.flatnonzero(counts <= budget)[-1])
        total, place, near = 0, 0, None
        for part in self.slices(text):
            pieces = self.pieces(part)
            totals = [self[piece][-1] for piece in pieces]
            whole = total + sum(totals)
            if near is None and whole > budget:
                near = self.around(text, place, total, zip(pieces, totals), budget)
            total, place = whole, place + len(part)
        if near is None:
            return total, len(text)
        start, ahead, end = near
        fits = self.plain_counts(text[start:end]) + ahead <= budget
        return total, start + int(np.flatnonzero(fits)[-1])

    @staticmethod
    def around(text: str, place: int, base: int, pieces, budget: int) -> tuple[int, int, int]:
        """Where to look for the end of the budget: start, tokens before it, and end.

        It lies in the first piece that exceeds the budget or, as blanks may join, in the next.
        """
        starts, over = [], 0
        for piece, n in pieces:
            starts.append((place, base))
            place, base = place + len(piece), base + n
            over += base > budget
            if over == 2:
                break
        k = len(starts) - over
        while k and text[starts[k][0] - 1].isspace():
            k -= 1
        return *starts[k], place

    def plain_counts(self, text: str) -> np.ndarray:
        """Counts at all prefixes of a text without added tokens."""
        out, base, place = np.zeros(len(text) + 1, np.int64), 0, 0
        for piece in self.pieces(text):
            inner = self[piece]
            end = place + len(piece)
            out[place + 1: end + 1] = np.frombuffer(inner, np.uint8)[1:] if isinstance(inner, bytes) else inner[1:]
            out[place + 1: end + 1] += base
            if piece in LONG_SUFFIXES:  # cut in the middle it is a quote and a word
                out[place + 2] = base + self["'"][-1] + self[piece[1]][-1]
            base, place = base + int(inner[-1]), end
        for run in self.blanks(text):  # the last blank joins the next word only if there is one
            inner = self[run[0]]
            out[run.start() + 1: run.end() + 1] = out[run.start()] + np.array(list(inner[1:]), np.int64)
        return out

    def counts(self, text: str) -> Iterator[np.ndarray]:
        """Counts at all prefixes, from the empty one to the whole text, in runs."""
        yield np.zeros(1, np.int64)
        base, place = 0, 0
        for mark in [*self.marks.finditer(text), None]:
            end = mark.start() if mark else len(text)
            for part in self.slices(text[place:end]):
                found = self.plain_counts(part)
                yield found[1:] + base
                last = part, base
                base += int(found[-1])
            if mark:  # inside its string an added token is ordinary text that joins what stands before
                part, before = last
                inside = self.plain_counts(part + mark[0][:-1])[len(part) + 1:] + before
                base += 1
                yield np.append(inside, base)
                place = mark.end()


def _texts(batch: pa.RecordBatch) -> Iterator[str]:
    for text in batch.column("text"):
        yield text.as_py() or ""


def _counted(tokenizer, limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = PrefixCounts(tokenizer.value)
        for batch in batches:
            totals, cuts = zip(*[counter.measured(text, limit) for text in _texts(batch)])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in batch.schema.names if c != "text"),
                 pa.array(totals, pa.int64()), pa.array(cuts, pa.int64())],
                [*(c for c in batch.schema.names if c != "text"), "n_tokens", "n_within"])
    return run


def _prefixes(tokenizer):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = PrefixCounts(tokenizer.value)
        for batch in batches:
            for i, key, text in zip(batch.column("id").to_pylist(), batch.column("key").to_pylist(), _texts(batch)):
                rest, part = np.empty(0, np.int64), 0
                for found in counter.counts(text):
                    rest = np.append(rest, found)
                    whole = len(rest) // PART_CHARS
                    yield from _parts(i, key, part, rest[: whole * PART_CHARS])
                    rest, part = rest[whole * PART_CHARS:], part + whole
                yield from _parts(i, key, part, rest)
    return run


def _parts(i, key, part: int, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(counts), 64 * PART_CHARS):
        here = counts[at: at + 64 * PART_CHARS]
        offsets = np.append(np.arange(0, len(here), PART_CHARS), len(here))
        n = len(offsets) - 1
        first = part + at // PART_CHARS
        yield pa.RecordBatch.from_arrays(
            [pa.array([i] * n, pa.int64()), pa.array([key] * n, pa.int64()),
             pa.array(np.arange(first, first + n), pa.int64()),
             pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(here, pa.int64()))],
            ["id", "key", "part", "counts"])


def read_tokenizer(path: str) -> str:
    """A tokenizer's JSON, read once on the driver; tasks get its text, a file of a few MB."""
    with open(path, encoding="utf-8") as file:
        return file.read()


def token_counts(docs: DataFrame, tokenizer: str, limit: int, text_col: str = "text") -> DataFrame:
    """All rows and columns of ``docs`` but its text, with its ``n_tokens`` and ``n_within`` (long).

    ``tokenizer`` is the JSON of a byte-level BPE tokenizer. Counts are those of its library
    without begin, end or padding tokens; the strings of added tokens inside a text count as
    one token. ``n_within`` is the length in code points of the longest prefix of at most
    ``limit`` tokens. Null and empty texts have no tokens. Repeated rows stay; columns named
    like the new ones are replaced.
    """
    kept = [c for c in docs.columns if c not in ("n_tokens", "n_within", text_col)]
    rows = docs.select(*kept, F.col(text_col).cast("string").alias("text"))
    fields = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in kept)
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer)
    return rows.mapInArrow(_counted(shared, limit), f"{fields}, n_tokens long, n_within long")


def prefix_counts(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The counts at all prefixes: rows (id, key, part, counts).

    ``counts`` are those of the prefixes of ``part * PART_CHARS`` code points and up to the next
    part, so a long text has many rows and none is large. ``key`` is a hash of the text, which
    tells texts of a repeated id apart. A null or empty text has one row with the count 0.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("key"),
                       F.col(text_col).cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer)
    return rows.mapInArrow(_prefixes(shared), "id long, key long, part long, counts array<long>")


def tokens_at(prefixes: DataFrame, asked: DataFrame) -> DataFrame:
    """``asked`` rows (id, length) with ``n_tokens`` of that prefix of each text of the id.

    Looked up in stored prefix counts; null where no text of the id is that long.
    """
    rows = asked.withColumn("part", F.floor(F.col("length") / PART_CHARS))
    place = (F.col("length") % PART_CHARS + 1).cast("int")
    return (rows.join(prefixes, ["id", "part"], "left")
            .select("id", "length", "key", F.try_element_at("counts", place).alias("n_tokens")))


def longest_within(prefixes: DataFrame, budget: int) -> DataFrame:
    """(id, key, length): the longest prefix of each text that has at most ``budget`` tokens."""
    fits = F.array_max(F.transform("counts", lambda c, i: F.when(c <= budget, i)))
    return (prefixes.select("id", "key", (F.col("part") * PART_CHARS + fits).alias("length"))
            .groupBy("id", "key").agg(F.max("length").alias("length")))
