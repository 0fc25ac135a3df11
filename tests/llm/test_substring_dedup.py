"""Removal of repeated passages against a plain count of all windows."""

import random
import re
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from counterfoil.llm import substring_dedup
from counterfoil.llm.common import WORD, table
from counterfoil.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


def plain(texts, window):
    """For each text its kept words, joined, and how many went."""
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    seen = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    kept = []
    for w in words:
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone.update(range(i, i + window))
        kept.append((" ".join(x for i, x in enumerate(w) if i not in gone), len(w), len(gone)))
    return kept


def passages(seed, size=40, words=30):
    """Texts that share pieces of all lengths, in all places."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(words)]
    pool = [[rng.choice(vocabulary) for _ in range(rng.randint(3, 60))] for _ in range(6)]
    texts = []
    for _ in range(size):
        text = []
        for _ in range(rng.randint(0, 6)):
            part = rng.choice(pool)
            at = rng.randrange(len(part))
            text += rng.choice([part, part[at:], part[:at], [rng.choice(vocabulary) for _ in range(8)], ["x"] * rng.randint(1, 30)])
        texts.append(rng.choice([" ", "\n", "\t "]).join(text))
    return texts


def check(spark, rows, window, seed, bits=64):
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("_row", F.lit(1)).withColumn("copies", F.lit("x"))
    got = substring_dedup.remove_repeats(docs.repartition(5), window=window, seed=seed, bits=bits).collect()
    want = [(i, *k) for (i, _), k in zip(rows, plain([t for _, t in rows], window))]
    return sorted(map(tuple, got), key=repr), sorted(want, key=repr)


@pytest.mark.parametrize("window,seed", [(9, 3), (5, 5), (6, 2)])
def test_equals_plain_count(spark, window, seed):
    texts = [*passages(window), None, "", "  ", "one", *passages(99, 3)[:2] * 2, "a " * 200, "a b " * 100]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, texts[3]), (3, texts[3]), (None, texts[4]), (None, "w1 w2"), (5, texts[0])]
    got, want = check(spark, rows, window, seed)
    assert got == want
    assert any(n for *_, n in want)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet="ab ", max_size=60), max_size=8))
def test_any_small_texts(spark, texts):
    got, want = check(spark, list(enumerate(texts)), 4, 2)
    assert got == want


def test_clashing_names_remove_no_clean_word(spark):
    """With names of few bits paths clash; what differs at the source stays."""
    rows = list(enumerate(passages(5)))
    got, want = check(spark, rows, 9, 3, bits=3)
    assert all(g[3] <= w[3] for g, w in zip(got, want))


def test_no_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert substring_dedup.remove_repeats(docs).collect() == []


def check_paths(texts, limit=None):
    """Paths cover the windows of each text one after the other."""
    texts = [[w.encode() for w in t] for t in texts]
    source, first, last, at, to, seeds, hashes = substring_dedup.Reader(35, 8).paths(texts)
    assert len(hashes) == sum(map(len, texts)) and len(seeds) == len(first)
    for n, words in enumerate(texts):
        mine = [(a, b) for s, a, b in zip(source, at, to) if s == n]
        assert [w for a, b in mine for w in range(a, b + 1)] == list(range(len(words) - 34))
    assert limit is None or len(first) < limit


def test_paths_cover_all_windows():
    words = ["same"] * 40 + [str(i % 400) for i in range(3000)]
    check_paths([words, [], ["a"] * 34, words[:35], words[5:50], ["b"]], 600)


def test_long_texts_in_parts(monkeypatch):
    """Texts longer than places have bits are cut; every window is still in one path."""
    monkeypatch.setattr(substring_dedup, "PLACE_BITS", 8)
    check_paths([[str(i) for i in range(1000)], ["x"] * 300])


@given(st.text(alphabet=st.characters() | st.sampled_from("\x1c\x1f\x85\xa0\u2003 \t\n\x0b\x0c\r")))
def test_words(text):
    raw = text.encode("utf-8", "surrogatepass")
    assert substring_dedup.words_of(raw) == [w.encode("utf-8", "surrogatepass") for w in WORD.findall(text)]


def test_query_on_documents(spark):
    docs = table(spark, SMALL, "documents").select("doc_id", "text").collect()
    import hashlib

    want = {
        d["doc_id"]: (n, gone, hashlib.sha256(kept.encode()).hexdigest())
        for d, (kept, n, gone) in zip(docs, plain([d["text"] for d in docs], 35))
    }
    got = QUERIES["op13_substring_dedup"](spark, SMALL).collect()
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got} == want
    assert len(got) == len(docs)
