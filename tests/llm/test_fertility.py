import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from catalogflow.llm import fertility
from tests.llm.conftest import ODD_ROWS


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {
        k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(i, i + 3)
    }
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)), len(covered), failed,
    )


BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_base_counts(sample, odd, vocabulary):
    path = vocabulary("piece_bpe_32k.model")
    texts = {r.doc_id: r.text for r in sample.collect()}
    for r in fertility.measure(sample, path).collect():
        assert tuple(r[c] for c in BASE) == brute(texts[r.doc_id])
    got = sorted(tuple(r[c] for c in BASE) for r in fertility.judge(odd, path).collect())
    assert got == sorted(brute(t) for _, t in ODD_ROWS)


def test_measures_equal_the_library(sample, vocabulary):
    import sentencepiece

    path = vocabulary("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    texts = ["Ordinary words, twice over.", "日本 語 \U0001f9ff x", ""]
    got = fertility.Meter(path)(texts)
    for k, text in enumerate(texts):
        ids = [i for w in text.split() for i in model.encode(w)]
        chars = sum(map(len, text.split()))
        assert got["chars_per_token"][k] == pytest.approx(chars / max(1, len(ids)))
        share = sum(map(model.is_byte, ids)) / max(1, len(ids))
        assert got["fallback_share"][k] == pytest.approx(share)


def test_junk_goes_and_clean_stays(spark, vocabulary):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = fertility.judge(docs, vocabulary("piece_bpe_32k.model")).join(docs, "doc_id")
    found = found.where("not base_failed")
    junk = F.col("n_symbols") > 0.3 * F.col("n_words")
    n_junk, junk_kept, n_clean, clean_kept = found.agg(
        F.count_if(junk), F.count_if(junk & F.col("kept")), F.count_if(~junk), F.count_if(~junk & F.col("kept"))
    ).first()
    assert clean_kept >= 0.99 * n_clean
    assert junk_kept <= 0.4 * n_junk


def test_odd_rows(odd, empty, vocabulary):
    path = vocabulary("piece_bpe_32k.model")
    assert not any(r.kept for r in fertility.judge(odd, path).collect() if r.base_failed)
    assert fertility.judge(empty, path).count() == 0
    assert fertility.keep_good(odd, path).columns == odd.columns


def test_scripts():
    assert fertility.script_of("Été 1") == "Latin"
    assert fertility.script_of("Привет, world") == "Cyrillic"
    assert fertility.script_of("123 ...") == "Other"
