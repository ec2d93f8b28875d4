"""Secrets in texts: fixed forms, and candidate strings of high sliding-window entropy.

Everything is a column expression; no row leaves the JVM.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faremeld.llm.common import table

# Forms of secrets, the least length of what is tested, and the group tested.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{16,}"
ASSIGN_LEAST = 12

#: Candidate strings and the width of the window that slides over them.
CANDIDATE, WINDOW = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}", 20
#: Character classes, the first that a whole candidate fits: name, pattern, least bits a character in a window.
CLASSES = (
    ("entropy_hex", "^[0-9a-fA-F]+$", 3.0),
    ("entropy_alnum", "^[A-Za-z0-9]+$", 3.6),
    ("entropy_base64", "^[A-Za-z0-9+/_=-]+$", 3.7),
)
#: Candidates that are no secrets: words, numbers, names joined by marks, UUIDs.
ALLOWED = (
    "^[A-Za-z]+$",
    "^[0-9]+$",
    "^[A-Za-z]*[/_=+-]?([A-Za-z]+[/_=+-])+[A-Za-z]*$",
    "^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
)
KINDS = ("assign", "access", "hex", *(name for name, _, _ in CLASSES))
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
#: Entropy is added up in these units, so that sums are exact.
SCALE = 1 << 20

SPAN = "struct<start:bigint,end:bigint,kind:int>"
#: Matches whose lengths are added up together.
BLOCK = 128


def _quoted(text: str) -> str:
    return "r'" + text.replace("'", r"\x27") + "'"


def _terms(window: int) -> list[int]:
    """count x log2(count) in SCALE units, for counts up to the window."""
    return [0, *(round(c * math.log2(c) * SCALE) for c in range(1, window + 1))]


def _spans(pattern: str, keep: str, kind: str) -> str:
    """SQL: spans of the matches m with text s, tested value v and number i for which `keep` holds.

    Positions add up the lengths between and of the matches, so they count code
    points: those of whole blocks of matches first, then those inside a block.
    No array grows by one match after the other.
    """
    p, length = _quoted(pattern), "m.gap + m.size"
    return f"""CASE WHEN NOT text RLIKE {p} THEN CAST(array() AS array<{SPAN}>) ELSE
      filter(transform(element_at(transform(
        array(filter(zip_with(split(text, {p}, -1), regexp_extract_all(text, {p}, 0), (gap, s) -> struct(length(gap) AS gap, length(s) AS size, s)), m -> m.s IS NOT NULL)),
        found -> element_at(transform(
          array(transform(sequence(0, CAST((size(found) - 1) div {BLOCK} AS int)), b -> aggregate(slice(found, b * {BLOCK} + 1, {BLOCK}), 0L, (n, m) -> n + {length}))),
          sums -> element_at(transform(
            array(transform(sequence(0, size(sums) - 1), b -> aggregate(slice(sums, 1, b), 0L, (n, x) -> n + x))),
            ahead -> transform(found, (m, i) -> struct(
              ahead[CAST(i div {BLOCK} AS int)] + aggregate(slice(found, i - i % {BLOCK} + 1, i % {BLOCK}), 0L, (n, m) -> n + {length}) + m.gap AS start, m.size AS size, m.s AS s))), 1)), 1)), 1),
        m -> element_at(transform(array(struct(m.start AS start, m.start + m.size AS end, m.s AS s)), x -> {kind}), 1)), x -> {keep}) END"""


def _plain(number: int) -> str:
    return f"struct(x.start AS start, x.end AS end, {number} AS kind)"


def _window_hits(window: int, alphabet: str) -> str:
    """SQL: first and last character (end exclusive) of the windows of candidate c whose bits reach least(c).

    Counts of the window's characters change by one as it moves, and with them
    the sum of count x log2(count); a window's bits are log2(w) - sum / w.
    """
    terms = "array(" + ",".join(f"{t}L" for t in _terms(window)) + ")"
    size = len(alphabet)
    return f"""aggregate(
      sequence(0, size(c.codes) - 1),
      struct(array_repeat(0, {size}) AS counts, 0L AS total, -1 AS first, -1 AS last),
      (acc, i) -> aggregate(
        array(struct(c.codes[i] AS come, CASE WHEN i >= {window} THEN c.codes[i - {window}] ELSE 0 END AS gone)),
        acc,
        (old, m) -> aggregate(
          array(CASE WHEN m.come = m.gone THEN old.total ELSE
            old.total + {terms}[old.counts[m.come - 1] + 1] - {terms}[old.counts[m.come - 1]]
            + CASE WHEN m.gone = 0 THEN 0L ELSE {terms}[old.counts[m.gone - 1] - 1] - {terms}[old.counts[m.gone - 1]] END END),
          old,
          (prev, total) -> struct(
            CASE WHEN m.come = m.gone THEN prev.counts ELSE
              transform(prev.counts, (n, k) -> n + CASE WHEN k = m.come - 1 THEN 1 ELSE 0 END - CASE WHEN k = m.gone - 1 THEN 1 ELSE 0 END) END AS counts,
            total AS total,
            CASE WHEN prev.first < 0 AND i >= {window} - 1 AND total <= c.most THEN i - {window} + 1 ELSE prev.first END AS first,
            CASE WHEN i >= {window} - 1 AND total <= c.most THEN i + 1 ELSE prev.last END AS last))),
      acc -> struct(acc.first AS first, acc.last AS last))"""


def entropy_spans(window: int = WINDOW, classes=CLASSES, allowed=ALLOWED) -> str:
    """SQL: spans from the first to the last window of enough bits, of every candidate that is not allowed."""
    p = _quoted(CANDIDATE)
    kind = "CASE " + " ".join(f"WHEN x.s RLIKE {_quoted(pattern)} THEN {3 + i}" for i, (_, pattern, _) in enumerate(classes)) + " ELSE -1 END"
    most = "CASE k.kind " + " ".join(f"WHEN {3 + i} THEN {most_total(bits, window)}L" for i, (_, _, bits) in enumerate(classes)) + " ELSE -1L END"
    allow = " OR ".join(f"s RLIKE {_quoted(a)}" for a in allowed) or "false"
    found = _spans(CANDIDATE, "true", f"struct(x.start AS start, x.s AS s, {kind} AS kind)").replace(
        f"CAST(array() AS array<{SPAN}>)", "CAST(array() AS array<struct<start:bigint,s:string,kind:int>>)", 1
    )
    codes = f"transform(regexp_extract_all(k.s, '.', 0), ch -> instr('{ALPHABET}', ch))"
    return f"""CASE WHEN NOT text RLIKE {p} THEN CAST(array() AS array<{SPAN}>) ELSE
      transform(filter(transform(
        transform(filter({found}, k -> k.kind >= 0 AND NOT ({allow.replace('s RLIKE', 'k.s RLIKE')})), k -> struct(k.start AS start, k.kind AS kind, {codes} AS codes, {most} AS most)),
        c -> struct(c.start AS start, c.kind AS kind, {_window_hits(window, ALPHABET)} AS hit)), h -> h.hit.first >= 0),
        h -> struct(h.start + h.hit.first AS start, h.start + h.hit.last AS end, h.kind AS kind)) END"""


def most_total(bits: float, window: int) -> int:
    """The largest sum of count x log2(count) of a window with so many bits a character."""
    return math.floor((math.log2(window) - bits) * window * SCALE)


def scan(docs: DataFrame) -> DataFrame:
    """Every row with `secret_spans`: (start, kind number, end) in this order.

    Positions are code points of the whole text, ends exclusive. Null text is
    taken as empty and has none. Forms keep their leftmost non-overlapping
    matches that are long enough; an assignment is tested on its value. A column
    of that name is replaced; others pass as they are.
    """
    p = _quoted(ASSIGN)
    values = f"transform(zip_with(SPANS, regexp_extract_all(text, {p}, 2), (x, v) -> struct(x.start AS start, x.end AS end, x.kind AS kind, length(v) AS n)), y -> y)"
    every = _spans(ASSIGN, "true", _plain(0))
    assign = f"""CASE WHEN NOT text RLIKE {p} THEN CAST(array() AS array<{SPAN}>) ELSE
      transform(filter({values.replace("SPANS", every)}, y -> y.n >= {ASSIGN_LEAST}), y -> struct(y.start AS start, y.end AS end, y.kind AS kind)) END"""
    access, hexes = _spans(ACCESS, "true", _plain(1)), _spans(HEX, "true", _plain(2))
    text = F.coalesce(F.col("text"), F.lit(""))
    kept = [c for c in docs.columns if c != "secret_spans"]
    inner = docs.select(F.struct(*kept).alias("_row"), text.alias("text"))
    spans = F.expr(f"array_sort(transform(concat({assign}, {access}, {hexes}, {entropy_spans()}), x -> struct(x.start AS start, x.kind AS kind, x.end AS end)))").alias("secret_spans")
    return inner.select("_row", spans).select("_row.*", "secret_spans")


def _joined(spans: str) -> str:
    names = "array(" + ",".join(f"'{k}'" for k in KINDS) + ")"
    return f"array_join(transform({spans}, x -> concat({names}[x.kind], ':', x.start, ':', x.end)), ',')"


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "secret_spans")
    return found.select(
        "doc_id",
        *[F.expr(f"CAST(size(filter(secret_spans, x -> x.kind = {i})) AS bigint)").alias(f"n_{KINDS[i]}") for i in range(3)],
        F.sha2(F.expr(_joined("filter(secret_spans, x -> x.kind < 3)")), 256).alias("base_sha256"),
        F.expr(_joined("secret_spans")).alias("spans"),
    )


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with every run of overlapping spans replaced by the mark."""

    def step(acc: Column, x: Column) -> Column:
        ahead = x["start"] >= acc["at"]
        piece = F.concat(F.substring(text, (acc["at"] + 1).cast("int"), (x["start"] - acc["at"]).cast("int")), F.lit(mark))
        return F.struct(F.greatest(acc["at"], x["end"]).alias("at"), F.when(ahead, F.concat(acc["out"], F.array(piece))).otherwise(acc["out"]).alias("out"))

    none = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("out"))
    done = F.aggregate(spans, none, step, lambda acc: F.concat(F.array_join(acc["out"], ""), F.substring(text, (acc["at"] + 1).cast("int"), F.length(text))))
    return F.when(F.size(spans) == 0, text).otherwise(done)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: secrets in texts become a mark; `n_chars` follows. Every document stays."""
    found = scan(docs)
    clean = found.select(*docs.columns, redacted(F.col("text"), F.col("secret_spans")).alias("_clean"), (F.size("secret_spans") > 0).alias("_hit"))
    new = {"text": F.when(F.col("_hit"), F.col("_clean")).otherwise(F.col("text"))}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.col("_hit"), F.length("_clean").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return clean.select(*[new[c].alias(c) if c in new else F.col(c) for c in docs.columns])


def _duck_spans(pattern: str, kind: int, test: str = "true") -> str:
    """DuckDB: the same spans of one form."""
    p = "'" + pattern.replace("'", "''") + "'"
    return f"""list_filter(list_transform(range(1, len(regexp_extract_all(t, {p})) + 1), lambda i:
      {{'start': CAST(coalesce(list_sum(list_transform(string_split_regex(t, {p})[1:i], lambda g: length(g))), 0)
                 + coalesce(list_sum(list_transform(regexp_extract_all(t, {p})[1:i - 1], lambda m: length(m))), 0) AS BIGINT),
        'm': regexp_extract_all(t, {p})[i], 'v': regexp_extract_all(t, {p}, {2 if kind == 0 else 0})[i], 'kind': {kind}}}), lambda x: {test})"""


def oracle() -> str:
    """The same rows in DuckDB, with each window's entropy counted anew."""
    classes = "CASE " + " ".join(f"WHEN regexp_matches(s, '{p}') THEN {3 + i}" for i, (_, p, _) in enumerate(CLASSES)) + " END"
    most = "CASE kind " + " ".join(f"WHEN {3 + i} THEN {most_total(bits, WINDOW)}" for i, (_, _, bits) in enumerate(CLASSES)) + " END"
    allow = " OR ".join(f"regexp_matches(s, '{a}')" for a in ALLOWED)
    names = "[" + ",".join(f"'{k}'" for k in KINDS) + "]"
    candidate, hexes = CANDIDATE.partition(")")[2], HEX.partition(")")[2]
    return f"""
    WITH d AS (SELECT doc_id, row_number() OVER () AS row_no, coalesce(text, '') AS t FROM documents),
    form AS (
      SELECT row_no, unnest(list_concat(
        {_duck_spans(ASSIGN, 0, f"length(x.v) >= {ASSIGN_LEAST}")},
        {_duck_spans(ACCESS, 1)}, {_duck_spans(hexes, 2)})) AS x FROM d),
    base AS (SELECT row_no, x.start AS s0, x.start + length(x.m) AS e0, x.kind AS kind FROM form),
    token AS (SELECT row_no, unnest({_duck_spans(candidate, 9)}) AS x FROM d),
    candidate AS (SELECT row_no, x.start AS start, x.m AS s FROM token),
    kept AS (SELECT *, {classes} AS kind FROM candidate WHERE NOT ({allow})),
    windows AS (SELECT row_no, start, kind, w, list_sum(list_transform(map_values(list_histogram(string_split(substring(s, w + 1, {WINDOW}), ''))),
        lambda c: CAST(round(c * log2(c) * {SCALE}) AS BIGINT))) AS total
      FROM (SELECT *, unnest(range(0, length(s) - {WINDOW} + 1)) AS w FROM kept)),
    entropy AS (SELECT row_no, start + min(w) AS s0, start + max(w) + {WINDOW} AS e0, kind FROM windows WHERE total <= {most} GROUP BY row_no, start, kind),
    spans AS (SELECT row_no, s0, e0, kind, {names}[kind + 1] || ':' || s0 || ':' || e0 AS said FROM (SELECT * FROM base UNION ALL SELECT * FROM entropy)),
    summed AS (SELECT row_no, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
        string_agg(said, ',' ORDER BY s0, kind) FILTER (kind < 3) AS base, string_agg(said, ',' ORDER BY s0, kind) AS spans FROM spans GROUP BY row_no)
    SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
      sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
    FROM d LEFT JOIN summed USING (row_no)"""
