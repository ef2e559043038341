"""Harmonic packing of token sequences.

A document's ids are cut into pieces; a piece of length l in (C/(k+1), C/k] belongs to class k, and a
bin of class k holds exactly k pieces. Every piece gets its rank in its class from per-bucket counts, so
each bucket fills its own run of bins without looking at any other. What is left of a class (fewer than k
pieces, a bounded number over all classes) is packed first-fit-decreasing in one bounded group.

Given the rows' numbers in a mixture, a bucket is a stretch of the mixture, so that ranks follow it, and a
sequence is called by the number of its first piece: sequences in order of their ids are the mixture.

Cutting keeps the padding small: while a remainder fills its class' slot badly, a piece that fills a
slot of the next class exactly is cut off.
"""

from __future__ import annotations

import gc
import json
import re
import unicodedata
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from pathlib import Path

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .storage import long_rows, materialise, trim

CAPACITY = 4096
#: Tokens of a slot that may stay empty before a remainder is cut once more.
SLACK = 16
#: Words that a worker remembers.
CACHE = 600_000

_PIECE = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+|\n")
#: The same for ASCII in lower case, which the plain module finds faster.
_ASCII = re.compile(r"[a-z]+|[0-9]|'(?:s|t|re|ve|m|ll|d)|[^\sa-z0-9]+|\n")
#: Above this, case folding and white space follow the tokenizer library itself.
_PLAIN = re.compile("[\n\x20-\x7e¡-ɏ]*")
#: Stands between words; no id is as large.
_STOP = b"\xff\xff\xff\xff"
#: What WordTokenizer does itself, as a tokenizer's file must define it.
_KNOWN = {
    "normalizer": ["NFC", "\\s+", "Lowercase"],
    "pre_tokenizer": ["'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+", "ByteLevel"],
}


def _byte_chars() -> dict[int, int]:
    """The byte-level alphabet: printable bytes stand for themselves, the others for characters from 256 on."""
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(keep)]
    return {b: b for b in keep} | {b: 256 + i for i, b in enumerate(rest)}


def _steps(part: dict | None) -> list[str]:
    """The kinds, or patterns, of a normalizer's or pre-tokenizer's parts."""
    parts = (part or {}).get("normalizers") or (part or {}).get("pretokenizers") or ([part] if part else [])
    return [p.get("pattern", {}).get("Regex") or p["type"] for p in parts]


@lru_cache(1)
def _loaded(path: str) -> tuple:
    """The tokenizer of a file, its model over split words, which ids end a word, special tokens, and whether WordTokenizer knows its kind.
    A worker reads a file once."""
    from tokenizers import Tokenizer, pre_tokenizers

    full = Tokenizer.from_file(path)
    kind = json.loads(Path(path).read_text())
    model = kind["model"]
    fast = all(_steps(kind.get(k)) == v for k, v in _KNOWN.items()) and model["type"] == "BPE" and model.get("end_of_word_suffix") == "</w>" and not model.get("dropout")
    words = Tokenizer(full.model)
    words.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
    ends = np.zeros(max(model["vocab"].values()) + 1, bool)
    ends[[i for t, i in model["vocab"].items() if t.endswith("</w>")]] = True
    return full, words, ends, [t["content"] for t in kind["added_tokens"]], fast


def _slices(raw: bytes, starts: list[int], stops: list[int]) -> Iterator[bytes]:
    return map(raw.__getitem__, map(slice, starts, stops))


class WordTokenizer:
    """Ids of whole texts by a tokenizer whose pre-tokens never span white space; words are looked up once and remembered.

    A tokenizer file that defines another normalizer or splitting than this class knows is left to the library.
    """

    def __init__(self, path: str, cache: int = CACHE):
        self.full, self.model, self.ends, self.special, self.fast = _loaded(path)
        self.table = _byte_chars() | {32: 32}
        self.cache, self.most = {"\n": _STOP}, cache

    def _pieces(self, new: list[str]) -> None:
        """Remembers pieces: what is neither split nor folded any further."""
        if not new:
            return
        text = " ".join(new).encode().decode("latin-1").translate(self.table)
        ids = np.array(self.model.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
        stops = np.flatnonzero(self.ends[ids]) + 1
        if len(stops) != len(new):
            raise ValueError("the tokenizer's pieces don't end where words do")
        self.cache.update(zip(new, _slices(ids.tobytes(), [0, *(4 * stops[:-1]).tolist()], (4 * stops).tolist()), strict=True))

    def _learn(self, words: list[str]) -> None:
        """Remembers words, all of them as one text of a word per line."""
        known = self.cache
        whole = "\n".join(words)
        if not _PLAIN.fullmatch(whole) or any(s in whole for s in self.special):
            plain = []
            for w in words:
                if _PLAIN.fullmatch(w) and not any(s in w for s in self.special):
                    plain.append(w)
                else:
                    known[w] = np.array(self.full.encode(w, add_special_tokens=False).ids, "<u4").tobytes()
            words = plain
        letters = [w.islower() and w.isalpha() for w in words]  # pieces themselves
        self._pieces([w for w, p in zip(words, letters, strict=True) if p])
        words = [w for w, p in zip(words, letters, strict=True) if not p]
        ascii_, other = [w for w in words if w.isascii()], [w for w in words if not w.isascii()]
        for part, pattern in ((ascii_, _ASCII), (other, _PIECE)):
            if not part:
                continue
            pieces = pattern.findall(unicodedata.normalize("NFC", "\n".join(part)).lower())
            self._pieces([p for p in dict.fromkeys(pieces) if p not in known])
            raw = b"".join(map(known.__getitem__, pieces))
            stops = 4 * np.flatnonzero(np.frombuffer(raw, "<u4") == 0xFFFFFFFF)
            known.update(zip(part, _slices(raw, [0, *(stops + 4).tolist()], [*stops.tolist(), len(raw)]), strict=True))

    def encode(self, texts: list[str | None], chars: int = 2_000_000) -> Iterator[np.ndarray]:
        """Ids of each text, in order; new words are learnt together for about `chars` characters."""
        group, size = [], 0
        for text in texts:
            group.append(text or "")
            size += len(group[-1])
            if size >= chars:
                yield from self._together(group)
                group, size = [], 0
        yield from self._together(group)

    def _together(self, texts: list[str]) -> Iterator[np.ndarray]:
        odd = [not self.fast or any(c in t for c in "\x1c\x1d\x1e\x1f") for t in texts]  # white space to Python, not to the tokenizer
        words = [[] if o else self._folded(t).split() for t, o in zip(texts, odd, strict=True)]
        if len(self.cache) > self.most:
            self.cache = {"\n": _STOP}
        # The group's own words are few enough to stay near the processor; those of all groups are looked up once a group.
        own = dict.fromkeys(chain.from_iterable(words))
        found = list(map(self.cache.get, own))
        missing = [w for w, raw in zip(own, found, strict=True) if raw is None]
        own = dict(zip(own, found, strict=True))
        if missing:
            self._learn(missing)
            own.update(zip(missing, map(self.cache.__getitem__, missing), strict=True))
        for t, o, some in zip(texts, odd, words, strict=True):
            if o:
                yield np.array(self.full.encode(t, add_special_tokens=False).ids, "<u4")
            else:
                yield np.frombuffer(b"".join(map(own.__getitem__, some)), "<u4")

    def _folded(self, text: str) -> str:
        """ASCII in lower case, which its ids don't depend on, unless it has a special token."""
        return text.lower() if text.isascii() and not any(s in text for s in self.special) else text


def cuts(n: int, capacity: int = CAPACITY, slack: int = SLACK) -> list[int]:
    """Lengths of the pieces of n ids, in order."""
    out = [capacity] * (n // capacity)
    rest = n % capacity
    while rest:
        k = capacity // rest
        if capacity // k - rest <= slack:
            return [*out, rest]
        out.append(capacity // (k + 1))
        rest -= out[-1]
    return out


def pieces(docs: DataFrame, tokenizer_path: str, end_id: int = 2, capacity: int = CAPACITY, number: str | None = None) -> DataFrame:
    """One row per piece of every whole document, with the class it belongs to and, if given, its document's number."""
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, k long"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tok = WordTokenizer(tokenizer_path)
        gc.disable()  # a few hundred thousand remembered words are no garbage, and looking through them again and again takes a tenth of the time
        for batch in batches:
            rows, numbers = [], []
            own = batch["number"] if number else [None] * len(batch)
            for i, at, ids in zip(batch["doc_id"], own, tok.encode(batch["text"].tolist()), strict=True):
                n, start = len(ids) + 1, 0
                raw = ids.tobytes() + end_id.to_bytes(4, "little")
                for size in cuts(n, capacity):
                    rows.append((i, start, size, zlib.crc32(raw[4 * start : 4 * (start + size)]), n, capacity // size))
                    start += size
                    numbers.append(at)
            out = pd.DataFrame(rows, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "k"]).astype({"doc_id": "Int64"})
            yield out.assign(number=numbers) if number else out
        del tok
        gc.enable()
        trim()

    columns = [F.col("doc_id").cast("long"), F.col("text"), *([F.col(number).cast("long").alias("number")] if number else [])]
    return long_rows(docs).select(*columns).mapInPandas(run, schema + (", number long" if number else ""))


def _tail(pdf: pd.DataFrame, capacity: int) -> pd.DataFrame:
    """First-fit decreasing over the classes' last pieces."""
    numbered = "piece" in pdf
    order = ["piece"] if numbered else ["doc_id", "start", "ids_crc32"]
    pdf = pdf.sort_values(["length", *order], ascending=[False, *[True] * len(order)], ignore_index=True)
    room, bins, offsets = np.zeros(0, np.int64), [], []
    for size in pdf["length"]:
        fits = np.flatnonzero(room >= size)
        if len(fits):
            b = fits[0]
        else:
            b, room = len(room), np.append(room, capacity)
        bins.append((1 << 60) + int(b))
        offsets.append(capacity - int(room[b]))
        room[b] -= size
    if numbered:
        bins = pdf["piece"].groupby(np.array(bins)).transform("min")
    return pdf.assign(sequence_id=bins, offset=offsets).drop(columns=["k", *order[: int(numbered)]]).astype({"doc_id": "Int64"})


def pack(docs: DataFrame, tokenizer_path: str, end_id: int = 2, capacity: int = CAPACITY, number: str | None = None) -> DataFrame:
    """Packs every document (doc_id, text) into sequences of at most `capacity` ids.

    Null or empty text: one piece with the end id alone. Null doc_ids and repeated rows are packed like any
    other row, once per row. An empty table gives no rows. Other columns are ignored. The classes' last pieces, fewer than
    k of each class k that cutting makes (some 21,000 in all, whatever the input), are packed in one task. `number` names a column
    of distinct numbers from 0 on: sequences, and the pieces within each class, then follow it.
    Returns doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.
    """
    spark = docs.sparkSession
    cols = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    cut = materialise(pieces(docs, tokenizer_path, end_id, capacity, number), "pieces")
    buckets = max(64, 2 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    if number:
        rows = (cut.agg(F.max("number")).first()[0] or 0) + 1
        cut, keys = cut.withColumn("bucket", F.expr(f"number * {buckets} div {rows}")), ["number", "start"]
    else:
        keys = ["doc_id", "start", "ids_crc32"]
        cut = cut.withColumn("bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)))
    # At most `capacity` classes times `buckets` rows. Spark broadcasts what is joined to the pieces only below its threshold; beyond it, the
    # pieces meet their class and bucket in the shuffle that ranking needs anyway.
    counts = cut.groupBy("k", "bucket").agg(F.count("*").alias("n"))
    base = counts.select(
        "k",
        "bucket",
        (F.sum("n").over(Window.partitionBy("k").orderBy("bucket")) - F.col("n")).alias("base"),
        F.sum("n").over(Window.partitionBy("k")).alias("of_class"),
    )
    if number:
        per = counts.groupBy("bucket").agg(F.sum("n").alias("n"))
        first = F.sum("n").over(Window.partitionBy(F.lit(0)).orderBy("bucket")) - F.col("n")  # a row per bucket
        base = base.join(per.select("bucket", first.alias("first")), "bucket")
    ranked = cut.join(base, ["k", "bucket"])
    if number:
        ranked = ranked.withColumn("piece", F.col("first") + F.row_number().over(Window.partitionBy("bucket").orderBy(*keys)) - 1)
    order = Window.partitionBy("k", "bucket").orderBy(*keys)
    ranked = ranked.withColumn("rank", F.col("base") + F.row_number().over(order) - 1)
    whole = F.col("rank") < F.expr("of_class - of_class % k")
    full = ranked.filter(whole).withColumn("sequence_id", F.expr("shiftleft(k, 44) + rank div k"))
    inside = Window.partitionBy("sequence_id").orderBy("rank")
    full = full.withColumn("offset", F.coalesce(F.sum("length").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long")))
    if number:
        full = full.withColumn("sequence_id", F.first("piece").over(inside))
    rest = (
        ranked.filter(~whole)
        .select(*cols[:5], "k", *(["piece"] if number else []), F.lit(0).alias("one"))
        .groupBy("one")
        .applyInPandas(lambda pdf: _tail(pdf.drop(columns="one"), capacity), "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
    )
    return full.select(*cols).unionByName(rest.select(*cols))
