import json
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from seriesmill.sources import landed, registry


def land(path, lines):
    path.mkdir(parents=True, exist_ok=True)
    (path / "page.json").write_text("\n".join(json.dumps(line) for line in lines))
    return str(path)


def ms(*parts):
    return int(datetime(*parts, tzinfo=UTC).timestamp() * 1000)


def test_spot(spark, tmp_path):
    path = land(
        tmp_path / "spot",
        [
            {"symbol": "BTC/USDT", "timeframe": "1d",
             "data": [[1704067200000, 1, 2, 0.5, 1.5, 10], [1704153600000, 2, 3, 1.5, None, 20]]},
            {"symbol": "ETH/USDT", "timeframe": "1d", "data": []},
            {"symbol": "LTC/USDT", "timeframe": "1d", "data": None},
        ],
    )
    rows = registry.read_source(spark, "spot", path).orderBy("time").collect()
    assert [(r.symbol, r.open, r.close, r.volume) for r in rows] == [
        ("BTC/USDT", 1.0, 1.5, 10.0), ("BTC/USDT", 2.0, None, 20.0)
    ]
    assert rows[0].time.strftime("%Y-%m-%d %H") == "2024-01-01 00"


def test_empty_folder_keeps_the_columns(spark, tmp_path):
    path = land(tmp_path / "spot", [])
    df = registry.read_source(spark, "spot", path)
    assert df.count() == 0
    assert df.columns == ["symbol", "timeframe", "time", "open", "high", "low", "close", "volume"]


def test_market(spark, tmp_path):
    (tmp_path / "m.csv").write_text(
        "Symbol , Date,Open, High ,Low,Close,Volume,Dividends\n"
        "^GSPC,2024-01-02,1,2,0.5,1.5,100,0\n"
        "^GSPC,2024-01-03,n/a,2,0.5,1.5,,0\n"
    )
    rows = registry.read_source(spark, "market", str(tmp_path / "m.csv")).orderBy("time").collect()
    assert [(r.symbol, r.open, r.volume) for r in rows] == [
        ("^GSPC", 1.0, 100.0), ("^GSPC", None, None)
    ]


@pytest.mark.parametrize(
    "day, utc_hour",
    [("2024-01-15", 6), ("2024-07-15", 5), ("2024-03-10", 6), ("2024-03-11", 5),
     ("2024-11-03", 5), ("2024-11-04", 6)],
)
def test_macro_days_start_at_central_midnight(spark, tmp_path, day, utc_hour):
    path = land(tmp_path / "macro", [{"symbol": "SOFR", "date": day, "value": 5.3}])
    df = registry.read_source(spark, "macro", path)
    row = df.select("*", landed.central_day(F.col("time")).alias("day")).first()
    assert (row.time.strftime("%Y-%m-%d %H:%M"), row.day) == (f"{day} {utc_hour:02d}:00", day)
    assert row.volume == 5.3


def test_macro_range_is_in_central_days(spark, tmp_path):
    path = land(
        tmp_path / "macro",
        [{"symbol": "SOFR", "date": f"2024-01-{d:02d}", "value": float("nan") if d == 3 else d}
         for d in range(1, 11)],
    )
    cut = landed.read_macro(spark, path, ms(2024, 1, 3, 5), ms(2024, 1, 6, 7))
    days = [r.d for r in cut.select(landed.central_day(F.col("time")).alias("d")).collect()]
    # 05:00Z on the 3rd is still the 2nd in the publisher's zone.
    assert sorted(days) == [f"2024-01-{d:02d}" for d in range(2, 7)]


def test_sentiment(spark, tmp_path):
    path = land(
        tmp_path / "fgi",
        [{"data": [
            {"value": "51", "value_classification": "Neutral", "timestamp": "1761523200",
             "time_until_update": "66568"},
            {"value": "n/a", "value_classification": "Fear", "timestamp": "1761436800"},
        ]}],
    )
    rows = registry.read_source(spark, "sentiment", path).orderBy("time").collect()
    assert [(r.symbol, r.timeframe, r.value, r.value_int) for r in rows] == [
        ("bitcoin_fgi", "1d", "n/a", None), ("bitcoin_fgi", "1d", "51", 51)
    ]
    assert rows[1].time == datetime(2025, 10, 26)


def test_derivatives(spark, tmp_path):
    base = ms(2024, 1, 1)
    hour = 3_600_000

    def feed(name, field, points, time="timestamp"):
        land(tmp_path / name, [
            {"symbol": "BTCUSDT", field: str(v), time: str(base + t)} for t, v in points
        ])

    feed("open_interest", "sumOpenInterestValue", [(0, 1.5), (hour, 2.5), (3 * hour, 3.5)])
    feed("taker_ratio", "buySellRatio", [(hour, 0.5)])
    feed("top_position_ratio", "longShortRatio", [(2 * hour, 0.25)])
    feed("top_account_ratio", "longShortRatio", [(0, 1), (0, 2)][:1])
    feed("global_account_ratio", "longShortRatio", [(0, "bad"), (hour, 7)])
    feed("funding", "fundingRate", [(417, 0.01)], "fundingTime")
    df = registry.read_source(
        spark, "derivatives", str(tmp_path), timeframe="1h", rows_per_task=None
    )
    rows = df.orderBy("time").collect()
    assert [r.open_interest_value for r in rows] == [1.5, 2.5, 2.5, 3.5]
    assert [r.taker_long_short_ratio for r in rows] == [0.5] * 4
    assert [r.top_long_short_position_ratio for r in rows] == [0.25] * 4
    assert [r.global_long_short_account_ratio for r in rows] == [7.0] * 4
    assert [r.funding_rate for r in rows] == [0.01] * 4
    forward = landed.read_derivatives(
        spark, str(tmp_path), "1h", backward=False, rows_per_task=None
    )
    assert [r.taker_long_short_ratio for r in forward.orderBy("time").collect()] == [
        None, 0.5, 0.5, 0.5
    ]


def test_payloads(spark):
    df = spark.createDataFrame(
        [('{"1":{"symbol":"BTC","last":2.5},"2":{"symbol":"ETH","last":null}}',),
         ("not json",)], "p STRING"
    )
    rows = df.select(
        *landed.explode_keyed(F.col("p"), "symbol: string, last: double", key="id")
    ).select("id", "entry.*").collect()
    assert sorted(map(tuple, rows)) == [("1", "BTC", 2.5), ("2", "ETH", None)]
    doc = spark.createDataFrame([('{"data":{"n":5,"q":{"USD":{"cap":1.5}}}}',)], "p STRING")
    row = doc.select(*landed.extract_paths(F.col("p"), {
        "n": ("$.data.n", "bigint"), "cap": ("$.data.q.USD.cap", "double"),
        "none": ("$.data.zzz", "string"),
    })).first()
    assert tuple(row) == (5, 1.5, None)


def test_coercion(spark):
    df = spark.sql("SELECT TIMESTAMP '2024-01-01' AS timestamp, 3 AS value, 4 AS other")
    row = landed.coerce_loaded(df)
    assert dict(row.dtypes) == {"timestamp": "bigint", "value": "double", "other": "int"}
    assert tuple(row.first()) == (1704067200000, 3.0, 4)
    plain = spark.sql("SELECT 'x' AS timestamp, 1.5D AS value")
    assert landed.coerce_loaded(plain).dtypes == plain.dtypes
