import random

from pyspark.sql import functions as F

from seriesmill.functions import names
from seriesmill.operators.membership import macro_catalogue, name_collisions


def test_sizes(spark):
    cases = {
        0: "0 B", -5: "0 B", None: "0 B", 1: "1 B", 1023: "1023 B", 1024: "1.0 KB",
        1280: "1.2 KB", 1024**2: "1.0 MB", 1024**3: "1.0 GB", 5 * 1024**4: "5120.0 GB",
        1024**2 - 1: "1024.0 KB",
    }
    df = spark.createDataFrame([(n,) for n in cases], "n BIGINT")
    for row in df.select("n", names.format_size(F.col("n")).alias("s")).collect():
        assert row.s == cases[row.n], row.n


def test_sizes_round_like_printf(spark):
    chosen = random.Random(3)
    sizes = [chosen.randrange(1024, 1 << chosen.randrange(11, 45)) for _ in range(3000)]
    sizes += [1024 * k + 1024 * j // 20 for k in range(1, 60) for j in range(20)]
    df = spark.createDataFrame([(n,) for n in sizes], "n BIGINT")
    for row in df.select("n", names.format_size(F.col("n")).alias("s")).collect():
        unit, name = next(
            (u, x) for u, x in ((1 << 10, "KB"), (1 << 20, "MB"), (1 << 30, "GB"))
            if row.n < u * 1024 or x == "GB"
        )
        assert row.s == f"{row.n / unit:.1f} {name}"


def parsed(spark, symbol):
    df = spark.createDataFrame([(symbol,)], "s STRING")
    row = df.select(names.parse_instrument(F.col("s")).alias("i")).first().i
    return None if row is None else tuple(row)


def test_instruments(spark):
    assert parsed(spark, "BTC/USDT") == ("BTC/USDT", "BTC/USDT", "BTC", "USDT", "", "", "", "")
    assert parsed(spark, "BTC/USDT:USDT")[2:] == ("BTC", "USDT", "USDT", "", "", "")
    assert parsed(spark, "BTC/USDT:BTC-211225-60000-P") == (
        "BTC/USDT:BTC-211225-60000-P", "BTC/USDT", "BTC", "USDT", "BTC", "211225", "60000", "P"
    )
    for bad in ["nosymbol", "A/B:C:D", "A/B/C", "A/B:a-b-c-d-e", "A:B/C"]:
        assert parsed(spark, bad) is None, bad


def test_routes(spark):
    cases = {
        "binance:BTC/USDT": ("binance", "BTC/USDT"),
        "Source:OKX:BTC/USDT": ("okx", "BTC/USDT"),
        "MyDataSource:BTC/USDT": ("binance", "BTC/USDT"),
        "BTC/USDT": ("binance", "BTC/USDT"),
        "BTC/USDT:USDT": ("btc/usdt", "USDT"),
        "a:b:c:d": ("binance", "a:b:c:d"),
    }
    df = spark.createDataFrame([(s,) for s in cases], "s STRING")
    for row in df.select("s", names.route_symbol(F.col("s")).alias("r")).collect():
        assert tuple(row.r) == cases[row.s], row.s


def test_dataset_names(spark):
    df = spark.createDataFrame([("binance:BTC/USDT_1d", "Crypto-Spot.v1")], "d STRING, s STRING")
    row = df.select(
        names.file_name(F.col("d")),
        names.table_name(F.col("d")),
        names.table_name(F.col("d"), F.col("s")),
        names.key_name(F.col("d"), F.col("s")),
        names.key_name(F.col("d")),
        names.table_name(F.lit("^GSPC=x_1d")),
        names.table_name(F.lit("600519.SS_1d")),
        names.squash_symbol(F.lit("BTC/USDT")),
    ).first()
    assert tuple(row) == (
        "binance:BTC_USDT_1d",
        "binance_btc_usdt_1d",
        "crypto_spot_v1_binance_btc_usdt_1d",
        "Crypto_Spot_v1:binance:BTC_USDT_1d",
        "binance:BTC_USDT_1d",
        "_gspc_x_1d",
        "tbl_600519_ss_1d",
        "BTCUSDT",
    )


def test_collisions(spark):
    df = spark.createDataFrame([("a/b",), ("a-b",), ("a_b",), ("c",), ("a/b",)], "dataset STRING")
    named = df.withColumn("name", names.table_name(F.col("dataset")))
    rows = name_collisions(named, "name").collect()
    assert {(r["name"], r["dataset"], r["n_datasets"]) for r in rows} == {
        ("a_b", "a/b", 3), ("a_b", "a-b", 3), ("a_b", "a_b", 3)
    }


def test_macro_catalogue(spark):
    counts = {
        (r.kind, r.freq): r["count"]
        for r in macro_catalogue(spark).groupBy("kind", "freq").count().collect()
    }
    assert counts == {
        ("rate", "Daily"): 13, ("volume", "Daily"): 6, ("volume", "Weekly"): 1
    }
