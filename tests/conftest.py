from __future__ import annotations

import os
import sys
from datetime import date, datetime, timezone
from decimal import Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from faremeld.schemas import QUOTES  # noqa: E402
from faremeld.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "faremeld-tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "2",
            # Compiling plans takes longer than running them on a few rows;
            # tests/oracle.py and bench.py run the compiled form.
            "spark.sql.codegen.wholeStage": "false",
            "spark.sql.codegen.factoryMode": "NO_CODEGEN",
            "spark.ui.showConsoleProgress": "false",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
            "spark.driver.bindAddress": "127.0.0.1",
            "spark.driver.host": "127.0.0.1",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


MONEY = ("price", "price_twd", "fx_rate")


def quote(**given) -> dict:
    """A priced quote in USD as a reader gives it; `given` replaces or fills fields, amounts as text."""
    row = dict.fromkeys(QUOTES.fieldNames())
    row.update(source="icruise", ship_name="Carnival Luminosa", cruise_line="Carnival Cruise Line", ship_name_raw="")
    row.update(sail_date=date(2026, 9, 5), nights=6, depart_port="Keelung", depart_port_raw="KEELUNG TW")
    row.update(ports_of_call=["Nagasaki", "Busan", "Jeju"], arrive_port="Jeju KR", detail_url="https://quotes.example/luminosa/6")
    row.update(price="612", currency="USD", price_note="per guest, taxes extra", other_sources={})
    row.update(scraped_at=datetime(2026, 8, 13, 19, 45, tzinfo=timezone.utc))
    row.update(given)
    return {k: Decimal(v) if k in MONEY and v is not None else v for k, v in row.items()}


def quotes_df(spark, rows):
    """Quotes with their list position as `row_ord`."""
    from pyspark.sql import types as T

    schema = T.StructType([*QUOTES.fields, T.StructField("row_ord", T.ArrayType(T.LongType()))])
    data = [tuple(r[f] for f in QUOTES.fieldNames()) + ([i],) for i, r in enumerate(rows)]
    return spark.createDataFrame(data, schema)


def values(spark, column, rows, dtype="string"):
    """Evaluate a column function over literal inputs."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, x {dtype}")
    return [r["v"] for r in df.select("i", column(F.col("x")).alias("v")).orderBy("i").collect()]
