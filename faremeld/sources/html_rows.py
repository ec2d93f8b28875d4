"""Raw pages to rows of raw cell texts, Arrow batch by Arrow batch.

The only Python in the read path. It locates cells and nothing else; every
parsed value (dates, prices, ports, nights) is a column expression.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterable

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from faremeld.sources import html_tree

# Executors need no copy of this package: its functions travel with the tasks.
cloudpickle.register_pickle_by_value(sys.modules[__package__.partition(".")[0]])


def explode_pages(
    pages: DataFrame,
    html: str,
    keep: list[str],
    fields: list[tuple[str, T.DataType]],
    read: Callable[[html_tree.Node], Iterable[dict]],
) -> DataFrame:
    """One output row per record that `read` finds in a page.

    Output: the `keep` columns of the page, `row_no`, then `fields`.
    """
    schema = T.StructType(
        [pages.schema[c] for c in keep]
        + [T.StructField("row_no", T.LongType())]
        + [T.StructField(n, t) for n, t in fields]
    )
    arrow_schema = to_arrow_schema(schema)
    names, parse = [n for n, _ in fields], html_tree.parse

    def run(batches):
        for batch in batches:
            kept = {c: batch.column(c) for c in keep}
            source, row_no, cells = [], [], {n: [] for n in names}
            for i, page in enumerate(batch.column(html).to_pylist()):
                for no, record in enumerate(read(parse(page))):
                    source.append(i)
                    row_no.append(no)
                    for n in names:
                        cells[n].append(record.get(n))
            at = pa.array(source, pa.int64())
            arrays = [kept[c].take(at) for c in keep] + [pa.array(row_no, pa.int64())]
            arrays += [pa.array(cells[n], arrow_schema.field(n).type) for n in names]
            arrays = [a.cast(arrow_schema.field(k).type) for k, a in enumerate(arrays)]
            yield pa.RecordBatch.from_arrays(arrays, schema=arrow_schema)

    return pages.select(*keep, html).mapInArrow(run, schema)
