"""Decomposition of series, and tables ordered along a curve."""

import random
from statistics import median

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from waybill.operators import clustering, decompose, storage

DAY, LAGS = 24, range(2, 60)


def planted(seed, n=24 * 20, rise=0.5, season=True, noise=3):
    """A rising trend with a daily shape, and outliers at known places."""
    rng = random.Random(seed)
    shape = [40 if 8 <= h < 18 else 12 if h < 20 else 0 for h in range(DAY)] if season else [0] * DAY
    rows = [100 + rise * i + shape[i % DAY] + rng.randrange(-noise, noise + 1) for i in range(n)]
    odd = sorted(rng.sample(range(30, n - 30), 6))
    for k, i in enumerate(odd):
        rows[i] += 45 if k % 2 else -45
    return [float(x) for x in rows], odd


def brute(values, lags, near=0.9, least=0.3):
    """(period, trend, season, residual) by the definitions."""
    def corr(x, y):
        mx, my = sum(x) / len(x), sum(y) / len(y)
        a = sum((p - mx) * (q - my) for p, q in zip(x, y, strict=True))
        b = (sum((p - mx) ** 2 for p in x) * sum((q - my) ** 2 for q in y)) ** 0.5
        return a / b if b else None

    d = [b - a for a, b in zip(values, values[1:], strict=False)]
    r = {k: corr(d[k:], d[:-k]) for k in lags if len(d) - k > 1}
    r = {k: v for k, v in r.items() if v is not None}
    best = max(r.values(), default=0)
    period = min((k for k, v in r.items() if v >= near * best), default=None) \
        if best >= least else None
    half = (period or max(lags)) // 2
    trend = [median(values[max(0, i - half):i + half + 1]) for i in range(len(values))]
    left = [v - t for v, t in zip(values, trend, strict=True)]
    phase = {p: median(left[p::period]) for p in range(period)} if period else {}
    season = [phase[i % period] if period else 0.0 for i in range(len(values))]
    return period, trend, season, [x - s for x, s in zip(left, season, strict=True)]


def test_outliers_on_a_rising_daily_series_are_found(spark):
    series = {"rising": planted(1), "flat": planted(2, rise=0), "aperiodic": planted(3, season=False),
              "falling": planted(4, rise=-0.2)}
    df = spark.createDataFrame([(k, i, v) for k, (vs, _) in series.items() for i, v in enumerate(vs)],
                               "k string, i int, v double")
    out = decompose.decompose(df, ["k"], "i", "v", LAGS)
    assert out.columns == ["k", "i", "v", "period", "trend", "season", "residual", "is_anomaly"]
    got = {}
    for r in out.collect():
        got.setdefault(r.k, {})[r.i] = r
    for k, (values, odd) in series.items():
        period, trend, season, rest = brute(values, LAGS)
        own = [got[k][i] for i in range(len(values))]
        assert {r.period for r in own} == {period}
        assert [(r.trend, r.season) for r in own] == list(zip(trend, season, strict=True))
        assert [round(r.residual, 9) for r in own] == [round(x, 9) for x in rest]
        assert set(odd) <= {r.i for r in own if r.is_anomaly}
    for k in ("rising", "flat", "falling"):
        flagged = {i for i, r in got[k].items() if r.is_anomaly}
        assert got[k][0].period == DAY
        # the trend itself is not flagged: nothing but the planted ones, away from the ends
        assert {i for i in flagged if DAY <= i < 19 * DAY} == set(series[k][1])
    assert got["aperiodic"][0].period is None


def test_short_and_constant_series(spark):
    df = spark.createDataFrame([("one", 0, 5.0), *(("flat", i, 7.0) for i in range(40))],
                               "k string, i int, v double")
    out = decompose.decompose(df, ["k"], "i", "v", range(2, 6)).collect()
    assert {(r.period, r.residual, r.is_anomaly) for r in out} == {(None, 0.0, False)}
    assert decompose.decompose(df.limit(0), ["k"], "i", "v", range(2, 6)).count() == 0


def row_groups(folder):
    """(min, max) of every row group by column."""
    out = []
    for f in folder.glob("*.parquet"):
        meta = pq.ParquetFile(f).metadata
        for g in range(meta.num_row_groups):
            group = meta.row_group(g)
            out.append({group.column(c).path_in_schema: (group.column(c).statistics.min,
                                                         group.column(c).statistics.max)
                        for c in range(group.num_columns)})
    return out


def test_a_filter_on_any_column_skips_most_files(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(60_000).select(
        "id", (F.xxhash64("id") % 1000).cast("int").alias("a"),
        F.format_string("%05d", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(40_000))).alias("b"),
        # half of all rows hold one value
        F.when(F.pmod(F.xxhash64("id", F.lit(2)), F.lit(2)) == 0, 7).otherwise(
            F.pmod(F.xxhash64("id", F.lit(3)), F.lit(500))).cast("int").alias("c"))
    storage.append(rows, path)
    want = rows.agg(F.sum(F.xxhash64(*rows.columns).cast("decimal(38,0)"))).first()[0]
    conf = {"spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.shuffle.partitions": "256"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        storage.compact(spark, path, ["a", "b", "c"], interleave=True)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    back = spark.read.parquet(path)
    assert back.agg(F.sum(F.xxhash64(*back.columns).cast("decimal(38,0)"))).first()[0] == want
    groups = row_groups(tmp_path / "t")
    assert len(groups) >= 200
    for column, value in (("a", 321), ("a", -900), ("b", "00017"), ("b", "31234"), ("c", 400),
                          ("c", 20)):
        opened = sum(g[column][0] <= value <= g[column][1] for g in groups)
        assert opened <= 0.45 * len(groups), (column, value, opened, len(groups))
    hot = sum(g["c"][0] <= 7 <= g["c"][1] for g in groups)
    files = back.filter("c = 7").groupBy(F.input_file_name()).count().collect()
    assert hot >= 20 and len(files) >= 20 and max(r["count"] for r in files) < 3000


def test_ranks_and_bits(spark):
    cuts = [2, 4, 4, 9]
    df = spark.createDataFrame([(None,), (1.0,), (2.0,), (4.2,), (9.0,), (99.0,)], "v double")
    assert [r[0] for r in df.select(clustering.rank(F.col("v"), cuts)).collect()] == [0, 0, 0, 3, 3, 4]
    z = spark.range(1).select(clustering.interleaved([F.lit(0b10), F.lit(0b11)], 2)).first()[0]
    assert z == 0b1101
    assert clustering.quantiles(df.limit(0), ["v"], 4) == {"v": []}
