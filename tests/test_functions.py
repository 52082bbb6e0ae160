import math

from pyspark.sql import functions as F

from regiscope.functions import format as FMT
from regiscope.functions import numeric as NUM
from regiscope.functions import text as TXT
from regiscope.plans.layers import REGION_DICTIONARY


def one_col(spark, values, dtype="string"):
    return spark.createDataFrame([(v,) for v in values], f"x {dtype}")


def test_standardize_maps_and_passes_through(spark):
    df = one_col(spark, [" kota adm. jakarta pusat ", "Kota Jakarta Pusat", "UNKNOWN X", None])
    out = [r[0] for r in df.select(TXT.standardize("x", REGION_DICTIONARY)).collect()]
    assert out == ["JAKARTA PUSAT", "JAKARTA PUSAT", "UNKNOWN X", None]


def test_dictionary_with_repeated_key_is_accepted(spark):
    df = one_col(spark, ["KEPULAUAN SERIBU"])
    pairs = [("A", "1"), ("A", "2"), ("KEPULAUAN SERIBU", "KS")]
    assert df.select(TXT.standardize("x", pairs)).first()[0] == "KS"


def test_standardize_join_matches_literal_map(spark):
    dic = spark.createDataFrame(REGION_DICTIONARY, "variant string, standard string")
    df = one_col(spark, ["kab. adm. kep. seribu", "Kota Jakarta Barat", "ELSEWHERE"]).withColumn("id", F.monotonically_increasing_id())
    got = {r["x"] for r in TXT.standardize_join(df, "x", dic).collect()}
    assert got == {"KEPULAUAN SERIBU", "JAKARTA BARAT", "ELSEWHERE"}


def test_recode(spark):
    df = one_col(spark, ["balita stunting", " Gizi Buruk "])
    assert [r[0] for r in df.select(TXT.recode("x", "BALITA STUNTING", "STUNTING")).collect()] == \
        ["STUNTING", "GIZI BURUK"]


def test_count_value_placeholder_and_bad_input(spark):
    df = one_col(spark, ["–", " 3 ", None, "abc", "12.5", "-1"])
    out = [r[0] for r in df.select(NUM.count_value("x")).collect()]
    assert out == [0, 3, 0, 0, 12, -1]


def test_lenient_cast_never_raises_under_ansi(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    df = one_col(spark, ["–", "x", "7"])
    assert [r[0] for r in df.select(NUM.lenient_cast("x", "int")).collect()] == [None, None, 7]


def test_scale_to_int_is_exact(spark):
    df = one_col(spark, ["28.8", "2230.7", "1815.6", "bad"])
    assert [r[0] for r in df.select(NUM.scale_to_int("x", 1000)).collect()] == [28800, 2230700, 1815600, None]


def test_ratio_per_guards_zero(spark):
    df = spark.createDataFrame([(5, 0), (5, 10000), (1, -3)], "n int, d int")
    out = [r[0] for r in df.select(NUM.ratio_per("n", "d", 10000)).collect()]
    assert out == [None, 5.0, None]


def test_sanitize_non_finite(spark):
    df = spark.createDataFrame([(float("nan"), [1.0, float("inf")]), (float("-inf"), None), (2.5, [3.0])],
                               "v double, a array<double>")
    rows = NUM.sanitize(df).collect()
    assert rows[0]["v"] is None and rows[0]["a"] == [1.0, None]
    assert rows[1]["v"] is None and rows[1]["a"] is None
    assert rows[2]["v"] == 2.5 and rows[2]["a"] == [3.0]


def test_canonical_name(spark):
    df = one_col(spark, ["KOTA ADMINISTRASI JAKARTA BARAT", "Kep. Seribu", None, "kota adm. jakarta pusat",
                         "Kabupaten Administrasi Kepulauan Seribu", "  Kota Jakarta Timur "])
    out = [r[0] for r in df.select(TXT.canonical_name("x")).collect()]
    assert out == ["JAKARTA BARAT", "KEPULAUAN SERIBU", "", "JAKARTA PUSAT", "KEPULAUAN SERIBU", "JAKARTA TIMUR"]


def test_title_case(spark):
    df = one_col(spark, ["JAKARTA BARAT", "kep.seribu-utara", "o'neill (1a b)", None])
    assert [r[0] for r in df.select(TXT.title_case("x")).collect()] == [
        "Jakarta Barat", "Kep.Seribu-Utara", "O'Neill (1A B)", None]


def test_display_helpers(spark):
    df = spark.createDataFrame([(1, 0.9171, 0.4715, True), (3, 1.2, 0.125, False), (5, 0.1, 0.0, None)],
                               "r int, s double, c double, a boolean")
    rows = df.select(FMT.rank_tier("r"), FMT.capped_percent("s"), FMT.rounded_percent("c"),
                     FMT.yes_no("a")).collect()
    assert [r[0] for r in rows] == ["1", "top", "mid"]
    assert math.isclose(rows[0][1], 91.71) and rows[1][1] == 100.0
    assert [r[2] for r in rows] == [47, 12, 0]
    assert [r[3] for r in rows] == ["Ya", "Tidak", None]


def test_iso_timestamp(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2024-05-06 07:08:09.123' AS t")
    assert df.select(FMT.iso_timestamp("t")).first()[0] == "2024-05-06T07:08:09"
