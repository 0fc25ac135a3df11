"""Token counts, language, rules, classifier and codec against libraries and plain versions."""

import math
import re
import zlib

import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from counterfoil.llm import language_id, quality_classifier, quality_rules, sentencepiece_codec, token_counts
from counterfoil.llm.common import table
from counterfoil.llm.queries import QUERIES, piece_model

SMALL = "/root/testdata/sf0.001"
LONG = "Haus und Hof, " * 4000 + "x" * 3000
EDGES = [
    "", " ", "  a  b   ", "\n\n x\ty", "aaa aaaa aaaaa", "日本語 😀 <s> </s> <unk> <0x0A>", "▁▁a▁ b", "é́ ​\x00z",
    "don't 12345 x².y", "a" * 3000, LONG,
]
IDS_AND_TEXTS = [(i, t) for i, t in enumerate(EDGES)] + [(None, "no id"), (7, None), (2, "  a  b   ")]


@pytest.fixture(scope="module")
def processor():
    return sentencepiece.SentencePieceProcessor(model_proto=piece_model())


@pytest.fixture(scope="module")
def edges(spark):
    rows = [(i, t, "other", 1) for i, t in IDS_AND_TEXTS]
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens string, _text int")


def test_counts_equal_the_library(spark, processor, edges):
    found = token_counts.count_tokens(edges, piece_model())
    assert found.columns == ["doc_id", "_text", "n_bytes", "n_tokens", "over_limit"]
    wanted = [(i, len((t or "").encode()), len(processor.encode(t or ""))) for i, t in IDS_AND_TEXTS]
    got = [(r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in found.collect()]
    assert sorted(got, key=repr) == sorted(wanted, key=repr)
    assert {r["over_limit"] for r in found.filter("n_tokens > 4096").collect()} == {True}


def test_counts_of_all_documents(spark, processor):
    texts = {r["doc_id"]: r["text"] for r in table(spark, SMALL, "documents").collect()}
    for row in QUERIES["op1_token_counts"](spark, SMALL).collect():
        assert row["n_tokens"] == len(processor.encode(texts[row["doc_id"]] or ""))


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab ▁é.,1\n😀<s>", max_size=40))
def test_counts_and_codec_of_any_text(text):
    processor = sentencepiece.SentencePieceProcessor(model_proto=piece_model())
    ids, parity, _ = sentencepiece_codec._codec(piece_model()).encode([text])
    wanted = processor.encode(text)
    assert list(memoryview(ids[0]).cast("i")) == wanted and parity == [True]
    assert token_counts._counter(piece_model()).count(text) == len(wanted)
    assert sentencepiece_codec._codec(piece_model()).decode([wanted]) == [processor.decode(wanted)]


def test_forgetting_changes_nothing():
    counter = token_counts.Counter(piece_model(), remembered=2)
    texts = ["one two three four", "two three five one", "one one two six"] * 3
    assert [counter.count(t) for t in texts] == [token_counts.Counter(piece_model()).count(t) for t in texts]


def test_codec_round_trip(spark, processor, edges):
    coded = sentencepiece_codec.encode(edges, piece_model())
    rows = sentencepiece_codec.decode(coded, piece_model()).collect()
    assert len(rows) == len(IDS_AND_TEXTS)
    by_ids = {tuple(processor.encode(t or "")): t or "" for _, t in IDS_AND_TEXTS}
    for row in rows:
        text = by_ids[tuple(row["ids"])]
        assert row["parity"] and row["n_tokens"] == len(row["ids"])
        assert row["text"] == processor.decode(row["ids"])
        assert row["round_trip"] == (row["text"] == text) == ("▁" not in text)


def test_codec_of_all_documents(spark, processor):
    texts = {r["doc_id"]: r["text"] for r in table(spark, SMALL, "documents").collect()}
    for row in QUERIES["op10_sentencepiece"](spark, SMALL).collect():
        assert list(row["ids"]) == processor.encode(texts[row["doc_id"]] or "") and row["parity"] and row["round_trip"]


def test_ids_are_those_of_the_rebuilt_tokenizer():
    codec = sentencepiece_codec.Codec(piece_model())
    proto = sentencepiece_codec.parse(piece_model())
    proto.normalizer_spec.add_dummy_prefix = False
    for piece in proto.pieces:
        piece.score = -piece.score
    codec.ours = sentencepiece_codec.build(proto.SerializeToString())  # wrong merges
    ids, parity, _ = codec.encode(["hello", ""])
    assert list(memoryview(ids[0]).cast("i")) == codec.ours.encode(" hello", add_special_tokens=False).ids
    assert parity == [False, True] and ids[1] == b""


def test_round_trip_is_that_of_the_whole_text(monkeypatch):
    texts = ["hello world", None, "", "a▁b", "éé 😀"] + ["one two three"] * 3
    codec = sentencepiece_codec.Codec(piece_model())
    for decoded in (1, 5, 250_000):
        monkeypatch.setattr(sentencepiece_codec, "DECODED", decoded)
        assert codec.encode(texts)[2] == [True, True, True, False, True, True, True, True]
    codec.built.decoder = sentencepiece_codec.decoders.Fuse()  # leaves marks in what users get
    assert codec.encode(texts)[2] == [False, True, True, False, False, False, False, False]


def test_unigram_model_keeps_its_scores():
    proto = sentencepiece_codec.parse(piece_model())
    proto.trainer_spec.model_type = sentencepiece_codec.UNIGRAM
    model = proto.SerializeToString()
    other = sentencepiece.SentencePieceProcessor(model_proto=model)
    texts = ["hello world", "Haus und Hof", "a  b"]
    built = sentencepiece_codec.build(model)
    assert [e.ids for e in built.encode_batch(texts, add_special_tokens=False)] == other.encode(texts)


# ---- language


def plain_phrases(symbols, sample):
    count, at = 0, 0
    while at < len(symbols):
        end = at
        while end < len(symbols) and symbols[at : end + 1] in sample:
            end += 1
        count, at = count + 1, max(end, at + 1)
    return count


def test_phrases_equal_plain_parsing():
    samples = {"x": ["abcabdabe aabb"], "y": ["cde cdf decade"]}
    model = language_id.Model(samples)
    texts = ["abcabde", "cdecdefdeca", "zzz", "a", "abz abd", "ab" * 700]
    for text in texts:
        symbols = "".join(chr(c) if c else " " for c in language_id.letters(text))
        want = []
        for at, lang in enumerate(model.langs):
            sample = samples[lang][0] + " "
            known = set("".join(samples["x"] + samples["y"])) | {" "}
            cut = [symbols[k : k + language_id.PIECE] for k in range(0, len(symbols), language_id.PIECE)]
            count = sum(plain_phrases("".join(c if c in known else "\x00" for c in piece), sample) for piece in cut)
            want.append(count * model.bits[at] / len(symbols))
        best = min(range(2), key=lambda k: (want[k], k))
        lang, score = model.scored([text])[0]
        assert lang == model.langs[best]
        assert score == pytest.approx(max(want) / sum(want))


def test_language_held_out_accuracy(spark):
    rows = language_id.identify(table(spark, SMALL, "documents")).collect()
    truth = {r["doc_id"]: r["lang"] for r in table(spark, SMALL, "documents").collect()}
    held = [r for r in rows if r["held_out"]]
    assert {r["doc_id"] for r in held} == {i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0}
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_edges(spark):
    rows = [(1, "eins zwei drei vier", "de"), (2, "one two three four", "en"), (3, None, "en"), (4, "12 !", None)]
    rows += [(None, "one two", "xx"), (6, "", "de"), (7, "eins zwei", None), (1, "eins zwei drei vier", "de")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {(r["doc_id"], r["lang_pred"]) for r in language_id.identify(docs).collect()}
    assert {(3, "und"), (4, "und"), (6, "und")} <= got
    assert all(lang in ("und", "de", "en") for _, lang in got)
    nothing = language_id.identify(docs.filter("lang is null and doc_id = 7"))
    assert [(r["lang_pred"], r["score"]) for r in nothing.collect()] == [("und", 0.0)]
    assert language_id.identify(docs.limit(0)).collect() == []


def test_languages_with_many_letters():
    import random

    # Words of as many letters as Chinese and Korean have, among languages with alphabets.
    rng = random.Random(5)
    kinds = {"ko": (0xAC00, 1500), "zh": (0x4E00, 2500), "xx": (0x61, 26), "yy": (0x430, 32), "zz": (0x5D0, 27)}
    words = {
        lang: ["".join(chr(first + rng.randrange(many)) for _ in range(rng.randint(1, 4))) for _ in range(800)]
        for lang, (first, many) in kinds.items()
    }
    sizes = {"ko": 2500, "zh": 2500, "xx": 1200, "yy": 4000, "zz": 4000}
    model = language_id.Model({lang: [" ".join(rng.choices(words[lang], k=sizes[lang]))] for lang in kinds})
    held = [(lang, " ".join(rng.choices(words[lang], k=60))) for lang in kinds for _ in range(20)]
    answers = model.scored([t for _, t in held])
    assert [lang for lang, _ in answers] == [lang for lang, _ in held]


def test_sample_of_a_language_does_not_depend_on_the_others():
    text = "".join(chr(0x61 + (k * k * 7 + k // 3) % 26) for k in range(9000))
    alone = language_id.Model({"a": [text]})
    many = language_id.Model({"a": [text]} | {f"b{k:03}": ["x y z"] for k in range(100)})
    assert many.bits[0] == alone.bits[0] == pytest.approx(math.log2(9002))


def test_moves_are_exact():
    import numpy as np

    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 10**10, 5000))
    moves = language_id.Moves(keys, np.arange(1, len(keys) + 1, dtype=np.int32))
    asked = np.concatenate([keys, rng.integers(0, 10**10, 5000)])
    known = dict(zip(keys.tolist(), range(1, len(keys) + 1)))
    assert moves.of(asked).tolist() == [known.get(k, 0) for k in asked.tolist()]


# ---- rules


def plain_rules(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[k : k + 8]) for k in range(len(words) - 7)]
    inside = {k + j for k, w in enumerate(windows) if windows.count(w) > 1 for j in range(8)}
    cover = []
    for n in (5, 10):
        grams = [tuple(words[k : k + n]) for k in range(len(words) - n + 1)]
        again = {k + j for k, g in enumerate(grams) if g in grams[:k] for j in range(n)}
        cover.append(sum(len(words[k]) for k in again) / max(1, sum(map(len, words))))
    return (
        len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"),
        sum(x in lines[:k] for k, x in enumerate(lines)), len(inside), *cover,
    )


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(["ab", "c", "é", "#x", "\n", "\x1c", "a\n"]), max_size=60))
def test_rules_of_any_text(parts):
    text = " ".join(parts)
    got = quality_rules.measured(text)
    assert (*got[:5], got[8], got[13]) == pytest.approx(plain_rules(text))


def test_rules_query(spark):
    texts = {r["doc_id"]: r["text"] for r in table(spark, SMALL, "documents").collect()}
    good = {r["doc_id"] for r in table(spark, SMALL, "labels").filter("quality = 1").collect()}
    rows = QUERIES["op8_quality_rules"](spark, SMALL).collect()
    for r in rows:
        if len(texts[r["doc_id"]]) < 4000:
            base = (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"])
            assert base == plain_rules(texts[r["doc_id"]])[:5]
    long_good = [r for r in rows if r["doc_id"] in good and r["n_words"] >= 20]
    assert sum(r["kept"] for r in long_good) >= 0.95 * len(long_good)


def test_rules_edges(spark):
    twice = "one two three four five six seven eight nine ten eleven twelve\n"
    rows = [(1, None), (2, ""), (3, " \n\n"), (4, "w " * 50_000), (None, twice * 9), (5, twice * 9)]
    got = quality_rules.apply_rules(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert all(r["base_failed"] and not r["kept"] for r in got) and len(got) == 6
    assert {r["n_dup_lines"] for r in got if r["doc_id"] == 5} == {8}
    assert quality_rules.apply_rules(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_windows_that_share_a_hash():
    import numpy as np

    place = np.array([0, 1, 0, 1, 2, 3])
    first = quality_rules._first_places(np.zeros(5, dtype=np.uint64), place, 2)
    assert first.tolist() == [0, 1, 0, 3, 4]


# ---- classifier


def test_classifier_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    label = {r["doc_id"]: r["quality"] for r in table(spark, folder, "labels").collect()}
    rows = QUERIES["op9_quality_classifier"](spark, folder).collect()
    held = [r for r in rows if r["held_out"] and r["doc_id"] in label]
    assert sum(r["predicted"] == label[r["doc_id"]] for r in held) >= 0.93 * len(held)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)


def test_classifier_edges(spark):
    rows = [(1, None), (2, ""), (3, "a" * 200_000), (None, "x"), (3, "a" * 200_000), (4, "some words"), (5, "more # #")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(4, 1), (5, 0), (5, 0), (None, 1), (9, 1), (1, None)], "doc_id long, quality int")
    both = quality_classifier.score_quality(docs, labels).collect()
    assert len(both) == 7 and all(0 <= r["score"] <= 1 for r in both)
    assert len({r["score"] for r in both if r["doc_id"] == 3}) == 1
    none = quality_classifier.score_quality(docs, labels.limit(0)).collect()
    assert {r["score"] for r in none} == {0.5}
    assert quality_classifier.score_quality(docs.limit(0), labels).collect() == []
    assert quality_classifier.keep_good(docs, labels.limit(0)).count() == 7


def test_classifier_judges_long_texts_as_it_judges_short_ones(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels").select("doc_id", "quality")
    model = quality_classifier.train(docs.select("doc_id", "text"), labels)
    rows = docs.join(labels, "doc_id").filter("text != '' and crc32(cast(doc_id as string)) % 5 = 0").collect()
    for quality in (1, 0):
        texts = sorted(r["text"] for r in rows if r["lang"] == "en" and r["quality"] == quality)
        joined = "\n".join(texts)
        start = quality_classifier.probability(joined[:6000], model)
        assert (start >= quality_classifier.THRESHOLD) == (quality == 1)
        for whole in ("\n".join([joined[:6000]] * 170), "\n".join([joined] * (1 + 1_000_000 // len(joined)))):
            score = quality_classifier.probability(whole, model)
            assert (score >= quality_classifier.THRESHOLD) == (quality == 1) and len(whole) > 1_000_000


def test_classifier_curve_sees_whole_texts(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text")
    texts = {r["doc_id"]: r["text"] * 20 for r in docs.collect() if r["text"]}
    long = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    built = (b"some good words " * 20, b"# $ % bad bad " * 20)
    points = quality_classifier.whole_measures(long, dict.fromkeys(texts, 1), built)
    got = {r.doc_id: (r.difference, r.ratio) for r in points.itertuples()}
    assert got == {i: quality_classifier.measures(t, *built) for i, t in texts.items()}
