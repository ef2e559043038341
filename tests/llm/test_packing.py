import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shoalframe.llm import packing
from shoalframe.llm.queries import tokenizer_path


@given(st.integers(0, 40_000))
def test_cuts_cover_a_document_in_slots_that_are_nearly_full(n):
    cut = packing.cuts(n)
    assert sum(cut) == n and all(0 < c <= 4096 for c in cut)
    assert all(4096 // (4096 // c) - c <= packing.SLACK for c in cut)


def test_words_are_encoded_as_the_library_does():
    from tokenizers import Tokenizer

    full = Tokenizer.from_file(tokenizer_path())
    texts = ["Don't STOP 12x3!!", "a<|endoftext|>b", "İΣσς ﬁ é 日本 x\x1cy", "", None, "   ", "it's we're '" * 5, "\x00 a​b"]
    for cache in (3, 1000):
        got = list(packing.WordTokenizer(tokenizer_path(), cache).encode(texts, chars=10))
        assert [g.tolist() for g in got] == [full.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_other_tokenizers_are_left_to_the_library(tmp_path):
    """A file with another splitting: the words aren't looked up one by one."""
    from tokenizers import Tokenizer, pre_tokenizers

    full = Tokenizer.from_file(tokenizer_path())
    full.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=True)
    full.save(str(tmp_path / "other.json"))
    tok = packing.WordTokenizer(str(tmp_path / "other.json"))
    texts = ["two  words, 12!", "", None]
    assert packing.WordTokenizer(tokenizer_path()).fast and not tok.fast
    assert [g.tolist() for g in tok.encode(texts)] == [full.encode(t or "", add_special_tokens=False).ids for t in texts]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(st.sampled_from("aBé'sTǆßİ 12!\n\t.<|¹ \u0301\u00ad")), max_size=5))
def test_any_text_is_encoded_as_the_library_does(texts):
    tok = packing.WordTokenizer(tokenizer_path(), 50)
    assert [g.tolist() for g in tok.encode(texts, chars=10)] == [tok.full.encode(t, add_special_tokens=False).ids for t in texts]


def test_a_word_is_learnt_once_in_any_case_and_the_file_is_read_once():
    tok = packing.WordTokenizer(tokenizer_path())
    learn, learnt = tok._learn, []
    tok._learn = lambda words: (learnt.extend(words), learn(words))
    texts = ["The stone, THE STONE", "the Stone, tHE sTONE", "<|endoftext|> The", "Élan élan The"]
    for chars in (10, 1000):
        got = [g.tolist() for g in tok.encode(texts, chars=chars)]
        assert got == [tok.full.encode(t, add_special_tokens=False).ids for t in texts]
    assert sorted(learnt) == sorted(["the", "stone,", "stone", "<|endoftext|>", "The", "Élan", "élan"])
    assert packing.WordTokenizer(tokenizer_path()).full is tok.full


def check(out, texts):
    from tokenizers import Tokenizer

    full = Tokenizer.from_file(tokenizer_path())
    seqs, docs = {}, {}
    for r in out:
        seqs.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        docs.setdefault(r["doc_id"], []).append(r)
    for parts in seqs.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
    for i, text in texts.items():
        ids = np.array([*full.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        at = 0
        for r in sorted(docs[i], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    return seqs


def test_pack(docs, rows):
    seqs = check(packing.pack(docs, tokenizer_path()).collect(), {r[0]: r[1] for r in rows})
    total = sum(n for parts in seqs.values() for _, n in parts)
    assert len(seqs) <= total // 4096 + 3  # hardly any padding, even on a small table


def test_repeated_rows_and_null_ids_are_each_packed(spark):
    table = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "c"), (None, None)], "doc_id long, text string")
    out = packing.pack(table, tokenizer_path()).collect()
    assert sorted((r["doc_id"] or -1, r["length"]) for r in out) == [(-1, 1), (-1, 2), (1, 3), (1, 3)]
    assert sorted(r["offset"] for r in out) == sorted({r["offset"] for r in out})


def test_full_bins_hold_their_class_count(spark):
    table = spark.range(700).select(F.col("id").alias("doc_id"), F.lit("the " * 1364).alias("text"))
    out = packing.pack(table, tokenizer_path())
    sizes = out.filter("sequence_id < 1152921504606846976").groupBy("sequence_id").agg(F.count("*").alias("n"), F.min("length").alias("l")).collect()
    assert sizes and all(r["n"] == 4096 // r["l"] for r in sizes)


@pytest.mark.parametrize("columns", [["doc_id", "text"], ["text", "doc_id", "slot"]])
def test_empty(nothing, columns):
    assert packing.pack(nothing.select(*columns), tokenizer_path()).count() == 0
