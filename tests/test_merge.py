from __future__ import annotations

import random
from datetime import date, datetime, timezone
from decimal import ROUND_HALF_EVEN, Decimal

from conftest import quote, quotes_df
from pyspark.sql import functions as F

from faremeld.functions.names import with_match_key
from faremeld.operators.dedupe import best_quotes, keep_cheapest, keep_last
from faremeld.operators.merge import merge_run, rows_after_run
from faremeld.operators.ordering import in_output_order, previous_in_order, sort_numeric, sort_text, with_position
from faremeld.operators.quality import merge_unmapped, run_report, run_totals, unmapped_names, unmapped_rows, unmapped_warning
from faremeld.schemas import RUN_STATUS, as_quotes

RATE = "32"


def merge(spark, previous, results, rate=RATE):
    """results: list of (source, quotes or None when it failed)."""
    current = [r for _, rows in results for r in rows or []]
    status = spark.createDataFrame(
        [(i, s, rows is not None, None if rows is not None else "timeout", 1.0) for i, (s, rows) in enumerate(results)],
        RUN_STATUS,
    )
    merged = merge_run(quotes_df(spark, current), quotes_df(spark, previous), status, F.lit(rate))
    return in_output_order(merged).collect()


def entry(price, currency="USD", twd=None):
    return {"price": price, "currency": currency, "price_twd": twd}


def others(row):
    return {k: v.asDict() for k, v in row.other_sources.items()}


def test_fresh_rows_replace_old_ones_and_sold_out_ones_vanish(spark):
    previous = [quote(stale_since=date(2026, 8, 1)), quote(ship_name="Costa Fortuna")]
    got = merge(spark, previous, [("icruise", [quote()])])
    assert [(r.ship_name, r.stale_since) for r in got] == [("Carnival Luminosa", None)]


def test_failed_and_unattempted_sources_keep_stale_rows(spark):
    old = datetime(2026, 8, 10, 5, tzinfo=timezone.utc)
    previous = [
        quote(source="cruisedirect", ship_name="A", scraped_at=old),
        quote(source="expedia", ship_name="B", scraped_at=old),
        quote(source="cruisedirect", ship_name="C", stale_since=date(2026, 8, 2)),
    ]
    got = merge(spark, previous, [("icruise", [quote()]), ("cruisedirect", None)])
    assert {r.ship_name: r.stale_since for r in got} == {
        "A": date(2026, 8, 10),
        "B": date(2026, 8, 10),
        "C": date(2026, 8, 2),
        "Carnival Luminosa": None,
    }


def test_failure_without_previous_rows_gives_nothing(spark):
    assert merge(spark, [], [("cruisedirect", None)]) == []


def test_cheapest_in_twd_wins_and_losers_are_kept(spark):
    got = merge(
        spark,
        [],
        [("icruise", [quote(price="3000")]), ("asiayo", [quote(source="asiayo", price="18000", currency="TWD")])],
    )
    assert [(r.source, r.price_twd, r.fx_rate) for r in got] == [("asiayo", Decimal(18000), None)]
    assert others(got[0]) == {"icruise": entry("3000", twd="96000")}
    got = merge(
        spark,
        [],
        [("icruise", [quote(price="379")]), ("asiayo", [quote(source="asiayo", price="18000", currency="TWD")])],
    )
    assert got[0].source == "icruise" and got[0].fx_rate == Decimal(32)


def test_price_beats_on_request(spark):
    got = merge(spark, [], [("icruise", [quote(price=None)]), ("expedia", [quote(source="expedia", price="1200")])])
    assert got[0].price == 1200 and others(got[0]) == {"icruise": entry(None)}


def test_without_rate_raw_numbers_are_compared(spark):
    got = merge(spark, [], [("icruise", [quote(price="100")]), ("expedia", [quote(source="expedia", price="900")])], None)
    assert (got[0].source, got[0].price_twd) == ("icruise", None)


def test_languages_and_port_group_merge(spark):
    got = merge(
        spark,
        [],
        [
            ("icruise", [quote(ship_name="Diamond Princess", depart_port="Yokohama", price="2812")]),
            ("asiayo", [quote(source="asiayo", ship_name="鑽石公主號", depart_port="Tokyo", price="68232", currency="TWD")]),
        ],
    )
    assert len(got) == 1 and others(got[0]) == {"icruise": entry("2812", twd="89984")}


def test_carried_quotes_are_requoted(spark):
    carried = quote(
        source="cruisedirect",
        price="379",
        other_sources={"expedia": entry("379.25"), "bad": entry("亂碼", twd="1"), "none": entry(None)},
    )
    got = merge(spark, [carried], [("cruisedirect", None)])
    assert others(got[0]) == {"expedia": entry("379.25", twd="12136"), "bad": entry("亂碼"), "none": entry(None)}


def test_same_source_loser_and_last_loser_per_source(spark):
    rows = [quote(price=p) for p in ("300", "100", "200")]
    got = merge(spark, [], [("icruise", rows)])
    assert got[0].price == 100 and others(got[0]) == {"icruise": entry("200", twd="6400")}
    got = merge(spark, [], [("icruise", [quote(price=p) for p in ("300", "200", "100")])])
    assert others(got[0]) == {"icruise": entry("200", twd="6400")}


def model(previous, results, rate):
    """Plain restatement of the merge rules over lists, as a test oracle."""
    by_source, rows, attempted = {}, [], set()
    for r in previous:
        by_source.setdefault(r["source"], []).append(r)
    for source, fresh in results:
        attempted.add(source)
        rows += [{**r, "stale": False} for r in fresh] if fresh is not None else [
            {**r, "stale": True} for r in by_source.get(source, [])
        ]
    for source, old in by_source.items():
        if source not in attempted:
            rows += [{**r, "stale": True} for r in old]
    one = Decimal(1)
    for r in rows:
        r["twd"] = None
        if r["price"] is not None and r["currency"] == "TWD":
            r["twd"] = r["price"].quantize(one, ROUND_HALF_EVEN)
        elif r["price"] is not None and r["currency"] == "USD":
            r["twd"] = (r["price"] * rate).quantize(one, ROUND_HALF_EVEN)
        r["amount"] = r["twd"] if r["twd"] is not None else r["price"]
    groups = {}
    for r in rows:
        groups.setdefault((r["ship_name"].lower(), r["sail_date"], r["nights"], r["depart_port"]), []).append(r)
    out = []
    for members in groups.values():
        rank = [(m["amount"] is None, m["amount"] or 0, i) for i, m in enumerate(members)]
        win = members[min(rank)[2]]
        lost = {m["source"]: (m["price"], m["twd"]) for m in members if m is not win}
        out.append((win, lost))
    out.sort(key=lambda w: (w[0]["sail_date"], w[0]["amount"] is None, w[0]["amount"] or 0))
    return [
        (w["source"], w["ship_name"], w["sail_date"], w["nights"], w["price"], w["twd"], w["stale"], lost) for w, lost in out
    ]


def test_random_runs_agree_with_the_model(spark):
    rng = random.Random(7)

    def some(source, n):
        return [
            quote(
                source=source,
                ship_name=rng.choice(["Alpha", "ALPHA", "Beta"]),
                sail_date=date(2026, 8, rng.randint(1, 3)),
                nights=rng.choice([3, 4]),
                depart_port="Keelung",
                price=rng.choice([None, "100", "100.5", "3200", "99.25", "200"]),
                currency=rng.choice(["USD", "TWD", "JPY"]),
            )
            for _ in range(n)
        ]

    for _ in range(6):
        sources = ["s1", "s2", "s3", "s4"]
        previous = [r for s in rng.sample(sources, 4) for r in some(s, rng.randint(0, 8))]
        rng.shuffle(previous)
        results = [(s, some(s, rng.randint(0, 9)) if rng.random() < 0.6 else None) for s in rng.sample(sources, 3)]
        got = [
            (
                r.source,
                r.ship_name,
                r.sail_date,
                r.nights,
                r.price,
                r.price_twd,
                r.stale_since is not None,
                {
                    k: (Decimal(v.price) if v.price else None, Decimal(v.price_twd) if v.price_twd else None)
                    for k, v in r.other_sources.items()
                },
            )
            for r in merge(spark, previous, results)
        ]
        assert got == model(previous, results, Decimal(RATE))


def test_key_ignores_case_spacing_and_line(spark):
    rows = [quote(), quote(ship_name="  CARNIVAL   LUMINOSA ", cruise_line="x", source="y", price="1")]
    keys = with_match_key(quotes_df(spark, rows)).select("k_ship", "k_port").distinct().collect()
    assert [tuple(k) for k in keys] == [("carnival luminosa", "keelung")]


def test_within_source_rules(spark):
    df = with_match_key(quotes_df(spark, [quote(price=None), quote(price="30"), quote(price="24"), quote(price="24")]))
    key = ["k_ship", "sail_date", "nights", "k_port"]
    row = keep_cheapest(df, key).first()
    assert (row.price, row.row_ord) == (24, [0])
    assert keep_last(df, key).first().row_ord == [0]


def test_output_order(spark):
    got = merge(
        spark,
        [],
        [
            (
                "icruise",
                [
                    quote(sail_date=date(2026, 8, 20), price="100"),
                    quote(sail_date=date(2026, 8, 10), price="900", ship_name="B"),
                    quote(sail_date=date(2026, 8, 10), price=None, ship_name="C"),
                    quote(sail_date=date(2026, 8, 10), price="100", ship_name="A"),
                ],
            )
        ],
    )
    assert [r.ship_name for r in got] == ["A", "B", "C", "Carnival Luminosa"]


def test_column_sorts(spark):
    df = spark.createDataFrame([(1, 5, "b"), (2, None, "A"), (3, 20, "a"), (4, 3, "B")], "id int, n int, t string")
    ids = lambda d: [r.id for r in d.collect()]
    assert ids(sort_numeric(df, F.col("n"))) == [4, 1, 3, 2]
    assert ids(sort_numeric(df, F.col("n"), False)) == [3, 1, 4, 2]
    assert ids(sort_text(df, F.col("t"))) == [3, 2, 1, 4]


def test_position_is_exact_over_partitions(spark):
    df = spark.range(0, 5000, 1, 7).withColumn("k", (F.col("id") * 7919) % 100)
    got = with_position(df, [F.col("k"), F.col("id")]).orderBy("k", "id").collect()
    assert [r.position for r in got] == list(range(1, 5001))


def test_previous_in_order_equals_lag_on_a_hot_key(spark):
    rng = random.Random(3)
    rows = [("hot" if rng.random() < 0.5 else f"u{rng.randint(0, 5)}", i, rng.choice(["a", "b", None])) for i in range(600)]
    df = spark.createDataFrame(rows, "u string, t int, v string")
    got = previous_in_order(df, ["u"], ["t"], "v", F.floor(F.col("t") / 50), "p").collect()
    last, want = {}, {}
    for u, t, v in rows:
        want[t] = last.get(u)
        last[u] = v
    assert {r.t: r.p for r in got} == want


def test_report_and_totals(spark):
    status = spark.createDataFrame([(0, "icruise", True, None, 1.234), (1, "bwt", True, None, 1.0), (2, "x", False, "e", 2.0)], RUN_STATUS)
    report = run_report(status, quotes_df(spark, [quote(), quote(source="x")]))
    got = {r.source: (r.ok, r["count"], r.duration_s, r.error) for r in report.collect()}
    assert got == {"icruise": (True, 1, 1.23, None), "bwt": (True, 0, 1.0, None), "x": (False, 0, 2.0, "e")}
    assert tuple(run_totals(report).first()) == (3, True, False)
    assert tuple(run_totals(report.where("false")).first()) == (0, False, False)
    assert run_totals(report.where("NOT ok")).first().all_failed


def test_unmapped_warning(spark):
    df = quotes_df(spark, [quote(ship_name="愛達魔都號"), quote(ship_name="愛達魔都號"), quote()])
    assert [r.warning for r in unmapped_warning(unmapped_names(df)).collect()] == ["這些船名沒有英文對照，無法跨來源比價：愛達魔都號"]
    assert unmapped_warning(unmapped_names(quotes_df(spark, [quote()]))).collect() == []
    many = quotes_df(spark, [quote(ship_name=f"愛達{i}") for i in range(5)] * 2)
    assert unmapped_warning(unmapped_names(many), listed=2).first().warning == "這些船名沒有英文對照，無法跨來源比價：愛達0、愛達1… (5)"


def test_unmapped_rows_over_runs(spark):
    first = unmapped_rows(quotes_df(spark, [quote(ship_name="愛達魔都號")] * 3 + [quote(), quote(ship_name="愛達", source="bwt")]), F.lit(0))
    second = unmapped_rows(quotes_df(spark, [quote(ship_name="愛達魔都號"), quote(ship_name="愛達魔都號", source="bwt")]), F.lit(1))
    got = sorted(tuple(r) for r in merge_unmapped(first, second).collect())
    assert got == [("愛達", "bwt", 1, 0, 0), ("愛達魔都號", "bwt", 1, 1, 1), ("愛達魔都號", "icruise", 1, 0, 1)]


def test_null_keys_keep_their_rows(spark):
    rows = [quote(ship_name="A", price_twd="10"), quote(ship_name="A", source="bwt", price_twd="20")]
    df = quotes_df(spark, rows).withColumn("k", F.lit(None).cast("string"))
    got = best_quotes(df, ["k"], "row_ord").collect()
    assert [(r.source, list(r.other_sources), r.k) for r in got] == [("icruise", ["bwt"], None)]

    df = spark.createDataFrame([(None, 1, "x"), (None, 60, "y"), ("u", 2, "z")], "u string, t int, v string")
    got = previous_in_order(df, ["u"], ["t"], "v", F.floor(F.col("t") / 50), "p").collect()
    assert {(r.u, r.t): r.p for r in got} == {(None, 1): None, (None, 60): "x", ("u", 2): None}


def test_absurd_price_is_unreadable(spark):
    df = spark.sql("SELECT source, CAST(p AS decimal(38,4)) AS price FROM VALUES ('a', '123456789012345678'), ('b', '12.5') AS t(source, p)")
    assert {r.source: r.price for r in as_quotes(df).collect()} == {"a": None, "b": Decimal("12.5")}


def test_quotes_are_not_dealt_by_source(spark):
    """A handful of sources must not gather all quotes in a handful of tasks (F6 to F9)."""
    rows = quotes_df(spark, [quote(), quote(source="bwt")])
    status = spark.createDataFrame([(0, "icruise", True)], "src_ord int, source string, ok boolean")
    plan = rows_after_run(rows, rows, status)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") == 3
