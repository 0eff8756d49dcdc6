"""Exact byte-level BPE ids by dynamic programming over prefixes.

A text is cut by the tokenizer's pattern; within a piece, the encoding of every prefix ends in exactly
one token. Scanning left to right, an automaton with suffix links lists the vocabulary entries that end
at each byte; the one that is compatible with the last token of the prefix before it is stored. Back
pointers then give the ids. Compatibility of two neighbouring tokens is decided by undoing, at their
seam, the merges that made them, latest first: if at any stage the two parts that meet would have
merged earlier than the merge just undone, the pair cannot stand in an encoding. No merge loop runs
over the text, so time is linear in its length.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ..session import parallelism

#: Fixed value: the pattern by which this vocabulary's texts are cut.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Where the vocabularies lie; a parameter of every function that needs one.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
#: Encodings of pieces that a worker keeps; beyond it the cache starts anew.
CACHED_PIECES = 200_000


def _byte_letters() -> dict[str, int]:
    """The printable stand-ins that vocabulary files use for bytes."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def read_vocabulary(path: str) -> tuple[list[bytes], np.ndarray]:
    """(bytes of each id, the two ids that each id was merged from; itself twice if never merged)."""
    model = json.loads(Path(path).read_text(encoding="utf-8"))["model"]
    letters, vocab = _byte_letters(), model["vocab"]
    names = sorted(vocab, key=vocab.get)
    if [vocab[n] for n in names] != list(range(len(names))):
        raise ValueError("ids have gaps")
    words = [bytes(letters[c] for c in n) if all(c in letters for c in n) else b"" for n in names]
    parts = np.repeat(np.arange(len(names), dtype=np.int32)[:, None], 2, axis=1)
    merged: list[tuple[int, int, int]] = []
    for m in model["merges"]:
        a, b = m.split(" ") if isinstance(m, str) else m
        merged.append((vocab[a + b], vocab[a], vocab[b]))
    for t, a, b in reversed(merged):
        # The earliest merge that gives a token is the one that is applied.
        parts[t] = (a, b)
    made = [t for t, _, _ in merged]
    if made != sorted(made):
        raise ValueError("merges are not in order of ids")
    special = set(model.get("special", []))
    return [b"" if i in special else w for i, w in enumerate(words)], parts


class PrefixEncoder:
    """Encodes pieces and texts with one vocabulary. One object per worker process."""

    def __init__(self, words: list[bytes], parts: np.ndarray):
        import ahocorasick
        import regex

        self.left = parts[:, 0].tolist()
        self.right = parts[:, 1].tolist()
        self.joined = {(a, b): t for t, (a, b) in enumerate(parts.tolist()) if a != t}
        self.size = [len(w) for w in words]
        self.by_word = {}
        self.ends = ahocorasick.Automaton()
        for t, w in enumerate(words):
            # Only entries that merges can reach stand in encodings; the others are special strings.
            if w and (len(w) == 1 or self.left[t] != t):
                self.by_word[w] = t
                self.ends.add_word(w.decode("latin-1"), t)
        self.ends.make_automaton()
        self.cut = regex.compile(PATTERN).findall
        self.known: dict[str, tuple[int, ...]] = {}
        self.seams: dict[tuple[int, int], bool] = {}

    def compatible(self, a: int, b: int) -> bool:
        """Whether tokens a, b may follow each other in an encoding."""
        key = (a, b)
        if (said := self.seams.get(key)) is not None:
            return said
        joined, left, right = self.joined.get, self.left, self.right
        # Merges up to `before` (exclusive) have been applied at this stage of undoing.
        before = len(left)
        fits = True
        while True:
            t = joined((a, b))
            if t is not None and t < before:
                fits = False
                break
            a_whole, b_whole = right[a] == a, left[b] == b
            if a_whole and b_whole:
                break
            # Undo the later merge; on equal tokens the left one was made first, so the right goes first.
            if not a_whole and (b_whole or a > b):
                before, a = a, right[a]
            else:
                before, b = b + 1, left[b]
        if len(self.seams) > 300_000:
            self.seams.clear()
        self.seams[key] = fits
        return fits

    def piece(self, word: bytes) -> tuple[int, ...]:
        """Ids of one piece."""
        if (whole := self.by_word.get(word)) is not None:
            return (whole,)
        n = len(word)
        last = [-1] * (n + 1)
        size, compatible = self.size, self.compatible
        for end, t in self.ends.iter(word.decode("latin-1")):
            end += 1
            if last[end] >= 0:
                continue
            start = end - size[t]
            if start == 0 or (last[start] >= 0 and compatible(last[start], t)):
                last[end] = t
        out, at = [], n
        while at:
            out.append(last[at])
            at -= size[last[at]]
        return tuple(reversed(out))

    def encode(self, text: str) -> list[int]:
        known, ids = self.known, []
        for p in self.cut(text):
            got = known.get(p)
            if got is None:
                got = self.piece(p.encode("utf-8"))
                if len(known) >= CACHED_PIECES:
                    known.clear()
                if len(p) <= 64:
                    known[p] = got
            ids.extend(got)
        return ids


_ENCODERS: dict[str, PrefixEncoder] = {}


def encoder(path: str = VOCABULARY) -> PrefixEncoder:
    """The process's encoder of a vocabulary file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = PrefixEncoder(*read_vocabulary(path))
    return _ENCODERS[path]


def spread(df: DataFrame, key: str) -> DataFrame:
    """``df`` over enough tasks for Python work. Text packs so well that a small file is one split; an
    input that already has as many splits as the session has shuffle partitions is left as it is."""
    n = max(parallelism(df.sparkSession), 2 * df.sparkSession.sparkContext.defaultParallelism)
    return df if df.rdd.getNumPartitions() >= n else df.repartition(n, key)


def encode_column(df: DataFrame, key: str, text: str, keep: list[str] | None = None, path: str = VOCABULARY, ids: str | None = "ids", count: str | None = None) -> DataFrame:
    """(key, kept columns, ids and/or number of ids) of every row, without special tokens.

    Null and empty texts give an empty list and 0. Marker strings are plain text. Texts of any length
    are encoded whole; rows repeat as they do in the input. The vocabulary is read once per worker
    process from ``path``, which must exist on every machine.
    """
    keep = [k for k in keep or [] if k != key]
    source = df.select(key, *keep, text)
    new = [T.StructField(ids, T.ArrayType(T.IntegerType()))] if ids else []
    new += [T.StructField(count, T.LongType())] if count else []
    schema = T.StructType([source.schema[c] for c in (key, *keep)] + new)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode
        for b in batches:
            at, flat = np.zeros(b.num_rows + 1, dtype=np.int32), []
            for i, t in enumerate(b.column(len(keep) + 1).to_pylist(), 1):
                got = encode(t) if t else []
                if ids:
                    flat.extend(got)
                at[i] = at[i - 1] + len(got)
            out = [b.column(i) for i in range(len(keep) + 1)]
            if ids:
                out.append(pa.ListArray.from_arrays(pa.array(at), pa.array(np.array(flat, dtype=np.int32))))
            if count:
                out.append(pa.array(np.diff(at).astype(np.int64)))
            yield pa.RecordBatch.from_arrays(out, names=schema.names)

    return spread(source, key).mapInArrow(run, schema)
