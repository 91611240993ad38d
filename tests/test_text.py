import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from textloom.functions import text as tx
from textloom.operators import postings as ops


def one(spark, value, expression):
    return spark.createDataFrame([(value,)], "text STRING").select(expression.alias("v")).first()["v"]


def test_words(spark):
    found = one(spark, "L'été, DON’T_stop 3.14 ÑANDÚ--a.b", tx.words("text"))
    assert found == ["l'été", "don’t_stop", "3", "14", "ñandú", "a", "b"]
    assert one(spark, None, tx.words("text")) == []


def test_lines(spark):
    cases = {
        "": [],
        "a": ["a"],
        "a\n": ["a"],
        "a\n\n": ["a", ""],
        "\n": [""],
        "a\r\nb\rc\nd": ["a", "b", "c", "d"],
    }
    for text, expected in cases.items():
        assert one(spark, text, tx.lines(F.col("text"))) == expected


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="ab \n\r", max_size=8), min_size=1, max_size=30))
def test_lines_agree_with_a_line_reader(spark, texts):
    import io

    rows = spark.createDataFrame([(t,) for t in texts], "text STRING")
    got = [r["v"] for r in rows.select(tx.lines(F.col("text")).alias("v")).collect()]
    assert got == [io.StringIO(t, newline=None).read().splitlines() if t else [] for t in texts]


def test_top_and_bottom_lines(spark):
    text = "one\ntwo\nthree\n"
    assert one(spark, text, tx.top_lines(F.col("text"), 2)) == "one two"
    assert one(spark, text, tx.bottom_lines(F.col("text"), 2)) == "two three"
    assert one(spark, "only", tx.top_lines(F.col("text"), 2)) == "only"
    assert one(spark, "only", tx.bottom_lines(F.col("text"), 2)) == "only"
    assert one(spark, "only", tx.bottom_lines(F.col("text"), 0)) == ""
    assert one(spark, "", tx.bottom_lines(F.col("text"), 2)) == ""


def test_times_are_utc_in_any_session_zone(spark):
    instant = F.timestamp_millis(F.lit(1_700_000_000_123))
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            row = spark.range(1).select(tx.to_millis_key(instant).alias("k"), tx.iso_time(instant).alias("i")).first()
            assert (row["k"], row["i"]) == ("20231114221320123", "2023-11-14T22:13:20.123Z")
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_clean_query(spark):
    assert one(spark, "A (broken) (Query", tx.clean_query(F.col("text"))) == "a broken query"


def test_positions_and_inverted_blocks(spark, docs):
    stacked = ops.stack_fields(docs, ["text"])
    vectors = {(r["doc_id"], r["term"]): r for r in ops.term_vectors(stacked, positions=True).collect()}
    assert vectors[(0, "red")]["positions"] == [0, 1] and vectors[(0, "red")]["tf"] == 2
    blocks = ops.invert_index(ops.term_vectors(stacked, positions=True), block_docs=2).where("term = 'green'")
    assert sorted((r["block"], r["n_docs"], r["entries"]) for r in blocks.collect()) == [
        (0, 1, "1:1:1"),
        (1, 1, "2:3:0,1,2"),
    ]


def test_offsets_point_at_the_words(spark):
    rows = [(0, "  Été -- don't stop."), (1, "x"), (2, ""), (3, "..."), (4, None)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    found = ops.token_offsets(ops.stack_fields(docs, ["text"])).collect()
    texts = {d: (t or "").lower() for d, t in rows}
    assert len(found) == 4
    for r in found:
        assert texts[r["doc_id"]][r["start_offset"] : r["end_offset"]] == r["term"]


def test_offsets_are_those_of_the_stored_text(spark, capsys):
    """Lower case of some letters is longer than the letter."""
    texts = {1: "\u0130stanbul und \u0130zmir, A\u0308 ok", 2: "", 3: None, 4: "  a"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id BIGINT, text STRING")
    found = ops.token_offsets(ops.stack_fields(docs, ["text"]))
    found.explain()
    assert "Exchange" not in capsys.readouterr().out
    got = sorted((r["doc_id"], r["pos"], r["term"], texts[r["doc_id"]][r["start_offset"] : r["end_offset"]]) for r in found.collect())
    assert got == [
        (1, 0, "i\u0307stanbul", "\u0130stanbul"), (1, 1, "und", "und"), (1, 2, "i\u0307zmir", "\u0130zmir"),
        (1, 3, "a\u0308", "A\u0308"), (1, 4, "ok", "ok"), (4, 0, "a", "a"),
    ]


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("It can't cost 3.14, or 1,000.5!", ["it", "can't", "cost", "3.14", "or", "1,000.5"]),
        ("www.example.com a.b. c:d e;f 7:8", ["www.example.com", "a.b", "c:d", "e", "f", "7", "8"]),
        ("snake_case __ _x_ a__b", ["snake_case", "_x_", "a__b"]),
        ("x2y 2nd v1.2a 3.x", ["x2y", "2nd", "v1.2a", "3", "x"]),
        ("\u6f22\u5b57\u304b\u306a \u30ab\u30bf\u30ab\u30ca\u30fc abc\u6f22", ["\u6f22", "\u5b57", "\u304b", "\u306a", "\u30ab\u30bf\u30ab\u30ca\u30fc", "abc", "\u6f22"]),
        ("l\u2019homme 'quoted' rock'n'roll", ["l\u2019homme", "quoted", "rock'n'roll"]),
        ("cafe\u0301 \u0939\u093f\u0928\u094d\u0926\u0940", ["cafe\u0301", "\u0939\u093f\u0928\u094d\u0926\u0940"]),
        ("x" * 600, ["x" * 255, "x" * 255, "x" * 90]),
        ("\u00bd \u00b2 $ -- ...", []),
        ("", []),
        (None, []),
    ],
)
def test_unicode_words(spark, text, want):
    from textloom.functions import text as tx

    rows = spark.createDataFrame([(text,)], "text STRING")
    assert rows.select(tx.unicode_words("text").alias("w")).first()["w"] == want
