import hashlib

import pytest
from pyspark.sql import functions as F

from folioscope.functions import ids, models, rules, vector
from folioscope.functions import text as tx


def one(spark, column, value=None, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(column.alias("r")).first().r




@pytest.mark.parametrize(("given", "ascii_", "unicode_"), [("Order Hub-2", "order_hub_2", "order_hub_2"), ("受注ハブ", "unknown", "受注ハブ"), ("__A  b__", "a_b", "a_b"), (None, "unknown", "unknown"), ("", "unknown", "unknown")])
def test_normalize_id(spark, given, ascii_, unicode_):
    assert one(spark, tx.normalize_id(F.col("v")), given) == ascii_
    assert one(spark, tx.normalize_id(F.col("v"), "unicode"), given) == unicode_


def test_ids_equal_hashlib(spark):
    assert one(spark, ids.document_id(F.lit("p"), F.col("v")), "a/b.md") == hashlib.sha256(b"p::a/b.md").hexdigest()[:16]
    assert one(spark, ids.content_hash(F.col("v")), "日本") == hashlib.sha256("日本".encode()).hexdigest()[:12]
    assert one(spark, ids.unit_label(F.col("v")), "sheet_07") == "s07" and one(spark, ids.unit_label(F.col("v")), "") == "doc" and one(spark, ids.unit_label(F.col("v")), "x" * 30) == "x" * 20
    assert one(spark, ids.chunk_id(F.lit("excel"), F.lit("abc"), F.lit("s01"), F.lit(7), F.col("v")), "dead") == "excel_abc_s01_c007_dead"


def test_canonical_scopes(spark):
    c = lambda t: one(spark, ids.canonical_id(F.lit(t), F.col("v"), F.lit("p"), F.lit("B 1"), F.lit("S")), "Order Hub")
    assert c("System") == "system:p:order_hub" and c("Field") == "field:p:b_1:s:order_hub" and c("FlowNode") == "flow_node:p:b_1:s:order_hub"
    assert c("BranchCondition") == "branch_cond:p:b_1:order_hub" and c("NewKindOfEntity") == "newkindofentity:p:b_1:order_hub"


def test_keywords(spark):
    q = "SAPから受注データをgetOrderで取得 マッピング the Warehouse"
    assert one(spark, tx.search_keywords(F.col("v")), q) == ["受注", "取得", "データ", "マッピング", "SAP", "getOrder", "the", "Warehouse"]
    terms = one(spark, tx.guidance_terms(F.col("v")), q)
    assert terms[0] == "SAP" and "Warehouse" in terms and "the" not in terms and len(terms) <= 12
    assert one(spark, tx.graph_keywords(F.col("v")), "see `Order Hub` and the Warehouse") == ["Order Hub", "Order", "Warehouse"]


def test_fields_and_sections(spark):
    t = "| 1 | name | x |\n| 2 | - | y |\n| 3 | total amount | z |"
    assert one(spark, tx.found_fields(F.col("v")), t) == ["name", "total amount"]
    assert one(spark, tx.found_fields(F.col("v")), "### A (`AB1234567`)\n### B (`AB1234567`)\n") == ["AB1234567"]
    assert one(spark, tx.leading_section(F.col("v")), "x\n## A") == "" and one(spark, tx.first_section(F.col("v")), "x\n## A\n## B") == "A"


@pytest.mark.parametrize(("v", "r"), [(None, ""), ("nan", ""), (" None ", ""), ("x", "x"), ("", "")])
def test_safe_str(spark, v, r):
    assert one(spark, tx.safe_str(F.col("v")), v) == r


def test_first_rule_decides(spark):
    assert one(spark, rules.chunk_type(F.col("v")), "the target workflow") == "flowchart"
    assert one(spark, rules.chunk_type(F.col("v")), "the target") == "api_spec"
    assert one(spark, rules.chunk_type(F.col("v")), "nothing") == "overview"
    assert one(spark, rules.file_type(F.col("v")), "a/b.XLSX") == "excel_sheet" and one(spark, rules.file_type(F.col("v")), "~$b.xlsx") == "unknown" and one(spark, rules.file_type(F.col("v")), "noext") == "unknown"


@pytest.mark.parametrize(("q", "label"), [("マッピングの変換", "mapping"), ("処理フローの手順", "flowchart"), ("API endpoint", "api"), ("field column", "field"), ("条件の判定", "rule"), ("全体の概要", "overview"), ("xyz", "overview")])
def test_intents(spark, q, label):
    i = one(spark, rules.query_intent(F.col("v")), q)
    assert i.label == label and (i.confidence == 0.1) == (q == "xyz")


def test_vectors(spark):
    a, b = F.array(*map(F.lit, (1.0, 0.0))), F.array(*map(F.lit, (0.0, 2.0)))
    assert one(spark, vector.squared_l2(a, b)) == 5.0 and one(spark, vector.cosine(a, a)) == 1.0
    assert one(spark, vector.cosine(a, F.array(F.lit(0.0), F.lit(0.0)))) is None


def test_models_are_deterministic_and_fail_softly(spark):
    df = spark.createDataFrame([("abc",), (None,), ("abc",)], "v string")
    rows = [r.r for r in df.select(models.embedded(F.col("v"), models.hashed_embedding(16)).alias("r")).collect()]
    assert rows[0] == rows[2] and len(rows[1]) == 16

    def broken(_):
        raise RuntimeError

    assert {r.r for r in df.select(models.answered(F.col("v"), broken).alias("r")).collect()} == {None}
    calls = []

    def flaky(texts):
        calls.append(1)
        if len(calls) < 2:
            raise RuntimeError
        return list(texts)

    assert models.with_retry(flaky, wait=0)(["x"]) == ["x"]


def test_sheet_kind_reads_the_whole_text(spark):
    df = spark.createDataFrame([("x" * 6000 + " endpoint",), ("x" * 6000,), (None,)], "t string")
    got = df.select(rules.sheet_kind(F.col("t")).alias("whole"), rules.sheet_kind(F.col("t"), parity=True).alias("parity")).collect()
    assert [tuple(r) for r in got] == [("api_request_response_spec", "unknown"), ("unknown", "unknown"), ("unknown", "unknown")]
