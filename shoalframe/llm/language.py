"""Language identification by compression: a text's language is the one whose dictionary compresses it best.

Per language, a raw-content zstandard dictionary of sampled passages; a text is folded to lower-case letters,
cut into blocks, and each block is encoded with every dictionary. The sizes' sums over the whole text decide.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .storage import long_rows

#: The bounded sample that the dictionaries are made of: texts of each language, bytes of each text, bytes of a dictionary.
TEXTS, PASSAGE, DICTIONARY = 64, 1500, 32768
BLOCK = 1024
#: A margin is narrow if the runner-up needs less than this times the root of the folded bytes more: sizes of a text that favours no
#: language differ like a random walk's ends (by about 0.2 at most in letters drawn at random). A tie is narrow at every length.
NARROW = 0.12

_REST = regex.compile(r"[^\p{L}\p{M}]+")
_ASCII_REST = re.compile(r"[^a-z]+")
_LETTER = regex.compile(r"\p{L}")
#: Blocks follow a run that always compresses, so that short blocks are never stored uncompressed.
_LEAD = b" " * 64


def fold(text: str | None) -> bytes:
    """The letters, in lower case, with one space for what is between them; nothing for a text without a letter."""
    low = (text or "").lower()
    if low.isascii():
        return _ASCII_REST.sub(" ", low).strip().encode()
    return _REST.sub(" ", low).strip().encode("utf-8", "replace") if _LETTER.search(low) else b""


class Classifier:
    """languages: the commoner first; equal sizes go to the first."""

    def __init__(self, passages: dict[str, bytes]):
        import zstandard as z

        self.languages = list(passages)
        self.coders, self.lead = [], []
        for text in passages.values():
            params = z.ZstdCompressionParameters.from_level(6, source_size=BLOCK + len(_LEAD), dict_size=DICTIONARY, min_match=3, write_content_size=False, write_checksum=False, write_dict_id=False)
            coder = z.ZstdCompressor(dict_data=z.ZstdCompressionDict(text, dict_type=z.DICT_TYPE_RAWCONTENT), compression_params=params)
            self.coders.append(coder)
            self.lead.append(len(coder.compress(_LEAD)))

    def sizes(self, folded: bytes) -> list[int]:
        blocks = [_LEAD + folded[i : i + BLOCK] for i in range(0, len(folded), BLOCK)]
        return [sum(len(c.compress(b)) for b in blocks) - n * len(blocks) for c, n in zip(self.coders, self.lead, strict=True)]

    def classify(self, text: str | None) -> tuple[str, float, bool]:
        """Language, score in 0..1, and whether to reject: no letter, or a narrow margin, such as a tie."""
        folded = fold(text)
        if not folded or not self.languages:
            return "und", 0.0, True
        sizes = np.array(self.sizes(folded), float)
        best = int(sizes.argmin())
        margin = float(np.partition(sizes, 1)[1] - sizes[best]) if len(sizes) > 1 else float(len(folded))
        score = float(1 / np.exp2(-np.minimum(sizes - sizes[best], 60)).sum())
        return self.languages[best], score, margin < NARROW * len(folded) ** 0.5


def learn(docs: DataFrame, train: object, texts: int = TEXTS, passage: int = PASSAGE, dictionary: int = DICTIONARY) -> dict[str, bytes]:
    """Dictionaries from at most `texts` texts of each language among the rows where `train` holds."""
    rows = docs.filter(train).filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).select("lang", "text", "doc_id")
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # a row per language
    if not counts:
        return {}
    by = Window.partitionBy("lang").orderBy("hash", "doc_id", "text")
    some = rows.select("lang", F.substring("text", 1, 4 * passage).alias("text"), "doc_id", F.xxhash64("doc_id", "text", F.lit("sample")).alias("hash"))
    # of each language, about eight times as many rows as are wanted are ranked, however many there are
    share = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, max(1, round(min(1.0, 8 * texts / n) * (1 << 40))))])
    some = some.filter(F.pmod("hash", F.lit(1 << 40)) < share[F.col("lang")])
    some = some.withColumn("n", F.row_number().over(by)).filter(F.col("n") <= texts).orderBy("lang", "n").collect()  # texts * languages rows
    passages = {}
    for lang in sorted(counts, key=lambda x: (-counts[x], x)):
        passages[lang] = b" ".join(fold(r["text"])[:passage] for r in some if r["lang"] == lang)[:dictionary]
    return {k: v.rjust(8) for k, v in passages.items()}  # a dictionary has 8 bytes at least


def identify(docs: DataFrame, passages: dict[str, bytes]) -> DataFrame:
    """doc_id, lang_pred, score, rejected for every row of docs, from its whole text alone.

    Null, empty or letterless texts (no character of category L), and all texts if no language was learnt: `und`, 0, rejected.
    Ties go to the language with more training rows, and are rejected. Null doc_ids and repeated rows are kept; an empty table gives no rows.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = Classifier(passages)
        for batch in batches:
            found = [model.classify(t) for t in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "lang_pred": [f[0] for f in found], "score": [f[1] for f in found], "rejected": [f[2] for f in found]})

    return long_rows(docs).select(F.col("doc_id").cast("long"), "text").mapInPandas(run, "doc_id long, lang_pred string, score double, rejected boolean")


def accepted(docs: DataFrame, passages: dict[str, bytes]) -> DataFrame:
    """The rows of docs, with all their columns, that are not rejected."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = Classifier(passages)
        for texts in batches:
            yield pd.Series([not model.classify(t)[2] for t in texts], dtype=bool)

    return long_rows(docs).filter(F.pandas_udf(run, "boolean")(F.col("text")))
