import json
import random

from pyspark.sql import functions as F

from counterfoil.functions.canonical import canonical_document
from counterfoil.operators import compare, quality
from counterfoil.plans.export import export_documents, write_exports
from counterfoil.sources.documents import as_json
from tests.conftest import rows


def docs_of(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "doc string")


def diff(spark, left, right):
    return tuple(compare.dataset_diff(docs_of(spark, *left), docs_of(spark, *right)).first())


def test_pairs(spark):
    assert diff(spark, ['{"Product Name":"a","q":1}'], ['{"q":1,"ProductName":"a"}']) == (1, 0, 0)
    assert diff(spark, ['{"x":[1,2]}'], ['{"x":[2,1]}']) == (0, 1, 1)
    assert diff(spark, ['{"a":null}'], ["{}"]) == (0, 1, 1)
    assert diff(spark, ['{"n":1}', '{"n":100}', '{"n":true}'], ['{"n":1.0}', '{"n":1e2}', '{"n":1}']) == (3, 0, 0)
    assert diff(spark, ['{"n":1}'], ['{"n":"1"}']) == (0, 1, 1)
    assert diff(spark, ['{"a":1}', '{"a":1}'], ['{"a":1}']) == (1, 1, 0)
    assert diff(spark, ['{"a b":{"c d":[{"e f":1}]}}'], ['{"ab":{"cd":[{"ef":1}]}}']) == (1, 0, 0)
    assert diff(spark, ['{"a":1}'], docs_of(spark).collect()) == (0, 1, 0)


def test_typed_pairs(spark):
    def one(expression):
        return spark.sql(f"select {expression}")

    def typed(left, right):
        return tuple(compare.typed_diff(one(left), one(right)).first())

    same, other = (1, 0, 0), (0, 1, 1)
    assert typed("1 as `a b`, 'x' as q", "'x' as q, cast(1.00 as decimal(6,2)) as ab") == same
    assert typed("10 as n", "cast(10 as double) as n") == same and typed("true as n", "1 as n") == same
    assert typed("100.50 as n", "cast(100.5 as decimal(18,3)) as n") == same and typed("100 as n", "1 as n") == other
    assert typed("1 as n", "'1' as n") == other and typed("null as n", "'null' as n") == other
    assert typed("array(1,2) as x", "array(2,1) as x") == other
    assert typed("cast(null as array<int>) as x", "array() as x") == other
    assert typed("array(named_struct('c d', 1, 'a', null)) as x", "array(named_struct('a', null, 'cd', 1)) as x") == same
    assert typed("date'2024-01-02' as d", "'2024-01-02' as d") == same
    assert typed("cast(null as struct<a:int>) as s", "named_struct('a', cast(null as int)) as s") == other


def test_key_collision_keeps_the_last(spark):
    got = docs_of(spark, '{"a b":1,"ab":2}', '{"ab":2}').select(canonical_document("doc")).distinct()
    assert got.count() == 1


def test_documents_are_compared_in_the_jvm(spark):
    docs = docs_of(spark, "1")
    plan = compare.dataset_diff(docs, docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def plain_form(value):
    """Objects without order and spaces in keys, whole numbers as such."""
    if isinstance(value, dict):
        return {"o": sorted((k, json.dumps(plain_form(v))) for k, v in {k.replace(" ", ""): v for k, v in value.items()}.items())} if value else []
    if isinstance(value, list):
        return [plain_form(v) for v in value]
    if isinstance(value, bool):
        return int(value)
    return int(value) if isinstance(value, float) and value.is_integer() else value


def test_random_documents_fall_into_the_same_classes(spark):
    """Two documents have one canonical text exactly if they are equal by the rules."""
    rng = random.Random(8)
    texts = ["", "a", "a b", 'q"', "\\", ':"', '",":', "é\n", "1", "true", "{}"]

    def value(depth):
        kind = rng.randrange(7 if depth else 5)
        if kind == 5:
            return [value(depth - 1) for _ in range(rng.randrange(3))]
        if kind == 6:
            return {rng.choice(["a b", "ab", "c", " c", 'x"y', "z:", "d\\"]): value(depth - 1) for _ in range(rng.randrange(3))}
        return [rng.choice(texts), rng.choice([0, 1, 100, -3, 10**20]), rng.choice([1.0, 100.0, 0.5, 1e20, -3.0, 1e-7, 2.5e30]),
                rng.choice([True, False]), None][kind]

    docs = [value(3) for _ in range(400)]
    written = [json.dumps(d, ensure_ascii=rng.random() < 0.5, indent=rng.choice([None, 1])) for d in docs]
    df = spark.createDataFrame(list(enumerate(written)), "n int, doc string")
    canonical = {r["n"]: r["c"] for r in df.select("n", canonical_document("doc").alias("c")).collect()}
    forms = [json.dumps(plain_form(json.loads(w))) for w in written]
    by_form, by_text = {}, {}
    for n, form in enumerate(forms):
        assert by_form.setdefault(form, canonical[n]) == canonical[n], (written[n], canonical[n])
        assert by_text.setdefault(canonical[n], form) == form, (written[n], canonical[n])


def shuffled_rows(spark, left, right):
    """Rows that the comparison counts one by one, behind the sums of buckets."""
    digests = [docs_of(spark, *texts).select(F.sha2(canonical_document("doc"), 256).alias("digest")) for texts in (left, right)]
    tagged = compare._tagged(*digests)
    return compare._open_digests(tagged, compare._bucket_sums(tagged)).count()


def test_equal_sides_move_no_rows(spark):
    texts = [json.dumps({"k": i % 900}) for i in range(2000)]
    assert shuffled_rows(spark, texts, texts[::-1]) == 0
    assert diff(spark, texts, texts[::-1]) == (2000, 0, 0)
    other = texts[:-1] + ['{"k":"new"}']
    assert 2 <= shuffled_rows(spark, texts, other) < 20
    assert diff(spark, texts, other) == (1999, 1, 1)
    # As many documents, in the same bucket or not, are no proof.
    assert diff(spark, texts[:2] * 2, texts[:2] + texts[1:2] * 2) == (3, 1, 1)
    assert diff(spark, [], []) == (0, 0, 0)


def test_escapes_in_keys(spark):
    assert diff(spark, [r'{"a\u0020b" : {  }}'], ['{"ab":[]}']) == (1, 0, 0)
    assert diff(spark, [r'{"a\\u0020b":1}'], ['{"ab":1}']) == (0, 1, 1)


def test_diff_against_counters(spark):
    rng = random.Random(5)
    texts = [json.dumps({"k": rng.randrange(6), "s x": [rng.randrange(2)]}) for _ in range(400)]
    left, right = texts[:250] + ['{"hot":1}'] * 200, texts[250:] + ['{"hot":1}'] * 50
    unmatched = left.copy()
    common = 0
    for text in right:
        if text in unmatched:
            unmatched.remove(text)
            common += 1
    assert diff(spark, left, right) == (common, len(left) - common, len(right) - common)


def test_exports_of_two_styles(spark, priced_shop, tmp_path):
    for side, style in (("l", "A"), ("r", "B")):
        write_exports(priced_shop, f"{tmp_path}/{side}", style)
    assert set(export_documents(priced_shop, "C")) == {"cust1.json", "cust2.json", "prod.json", "ord.json"}
    names = ["cust1.json", "cust2.json", "ord.json", "prod.json", "none.json", "custom.json"]
    report = compare.compare_folders(spark, f"{tmp_path}/l", f"{tmp_path}/r", names)
    assert rows(report) == [
        ("cust1.json", "compared", 5, 0, 0),
        ("cust2.json", "compared", 1, 4, 4),
        ("none.json", "not found", None, None, None),
        ("ord.json", "compared", 4, 0, 0),
        ("prod.json", "compared", 3, 4, 4),
    ]


def test_id_positions(spark):
    make = lambda ids: spark.createDataFrame([(i,) for i in ids], "OrderID long")
    left, right = make([3, 1, 2, None]), make([4, 3, 2])
    assert rows(compare.id_positions_missing(left, right)) == [("left", 1, 0), ("right", 4, 2)]
    assert not compare.same_ids(left, right).first()[0] and compare.same_ids(left, make([1, 2, 3])).first()[0]
    assert not compare.same_ids(left, make([1, 2, 3, 3])).first()[0]
    assert [r[0] for r in compare.ids_of(left).collect()] == [1, 2, 3]


def test_id_positions_with_repeats_over_many_blocks(spark):
    rng = random.Random(9)
    a = [rng.randrange(-(1 << 62), 1 << 62) for _ in range(300)] + [7] * 50
    b = rng.sample(a, 200) + [rng.randrange(1 << 40) for _ in range(40)]
    frames = [spark.createDataFrame([(i,) for i in ids], "OrderID long") for ids in (a, b)]
    want = []
    for side, mine, other in (("left", a, b), ("right", b, a)):
        want += [(side, i, p) for p, i in enumerate(sorted(mine)) if i not in set(other)]
    assert rows(compare.id_positions_missing(*frames)) == sorted(want, key=repr)


def test_an_id_repeated_very_often(spark):
    left = spark.range(150_000).selectExpr("9 as OrderID").unionAll(spark.range(3).selectExpr("id as OrderID"))
    got = compare.id_positions_missing(left, spark.range(3).selectExpr("id as OrderID"))
    assert rows(got.agg(F.count("*"), F.countDistinct("position"), F.min("position"), F.max("position"))) == [
        (150_000, 150_000, 3, 150_002)
    ]


def test_keys_references_nulls_lengths(spark, shop):
    lines = shop.lines
    assert quality.pk_violations(lines, ["order_id", "product_id"]).count() == 0
    assert rows(quality.pk_violations(lines.unionAll(lines.where("order_id = 14")), ["order_id", "product_id"])) == [(14, 2, 2)]
    assert rows(quality.fk_orphans(lines, "product_id", shop.products.where("id <> 3")).select("order_id")) == [(12,)]
    assert quality.fk_orphans(shop.customers, "zip", shop.cities, "zip").count() == 0  # NULL zip allowed
    assert rows(quality.null_counts(shop.customers, ["firstName", "lastName", "zip"])) == [(1, 0, 1)]
    assert rows(quality.length_violations(shop.products, {"name": 4})) == [(5,)]


def test_upsert(spark):
    target = spark.createDataFrame([(1, 1, 5, "a"), (1, 2, 6, "b")], "o long, p long, q int, note string")
    source = spark.createDataFrame([(1, 1, 9, 1), (1, 1, None, 2), (2, 1, 4, 1)], "o long, p long, q int, seq long")
    assert rows(quality.upsert(target, source, ["o", "p"], "seq")) == [(1, 1, None, "a"), (1, 2, 6, "b"), (2, 1, 4, None)]


def test_document_text_keeps_nulls(spark):
    df = spark.range(1).select(F.lit(None).cast("int").alias("a b"), F.lit(1.5).cast("decimal(6,2)").alias("c"))
    assert df.select(as_json(df)).first()[0] == '{"a b":null,"c":1.50}'


def test_a_document_is_parsed_once(spark):
    plan = docs_of(spark, "1").select(canonical_document("doc"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("to_json(") + plan.count("to_json,") == 1


def test_texts_that_look_like_keys_stay(spark):
    """Documents without escapes are not cut into tokens; texts keep their spaces, keys lose them."""
    pairs = {
        '{"a b": "c d", "e": ["f g", ":h i", " :"]}': '{"ab":"c d","e":["f g",":h i"," :"]}',
        '{"k 1" : {"a b,": "x, y"}, "z": "a b"}': '{"k1":{"ab,":"x, y"},"z":"a b"}',
        '{"a b":true,"c d":{ },"e":"true {}"}': '{"ab":1,"cd":[],"e":"true {}"}',
        '{"a b":"x\\"y z","c d":1.50}': '{"ab":"x\\"y z","cd":1.5}',
    }
    got = docs_of(spark, *pairs).select("doc", canonical_document("doc").alias("c")).collect()
    assert {r["doc"]: r["c"] for r in got} == pairs
