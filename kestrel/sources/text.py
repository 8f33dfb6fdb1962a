"""Text-line sources: the reference's file formats, parsed with built-in columns.

Every parser takes a DataFrame with one string column ``value`` (what
``spark.read.text`` returns, or lines Spark derives from a table) and returns
typed columns. Parsing is split/trim/cast on the JVM side; no Python runs per
row. ``mode`` is the bad-row policy:

* ``FAILFAST`` (default, the reference's behaviour): a short row or a
  non-numeric field raises (ANSI cast / strict array index).
* ``PERMISSIVE``: bad fields become NULL.
* ``DROPMALFORMED``: rows with a bad or missing field are dropped.

Spark's ``split`` takes a Java regex; literal separators are quoted with
``\\Q…\\E`` so a bare ``|`` is not read as alternation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MODES = ("FAILFAST", "PERMISSIVE", "DROPMALFORMED")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line, column ``value`` (CRLF handled by the reader)."""
    return spark.read.text(path)


def _literal(sep: str) -> str:
    return "\\Q" + sep + "\\E"


def _check_mode(mode: str) -> str:
    mode = mode.upper()
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, got {mode!r}")
    return mode


def _field(parts: Column, i: int, mode: str) -> Column:
    if mode != "FAILFAST":
        return F.get(parts, i)
    return F.when(F.size(parts) > i, F.get(parts, i)).otherwise(
        F.raise_error(F.lit(f"malformed line: no field {i}")).cast("string"))


def _cast(c: Column, typ: str, mode: str) -> Column:
    got = c.try_cast(typ)
    if mode != "FAILFAST":
        return got
    # raised here, whatever the session's ANSI setting
    return F.when(c.isNull() | got.isNotNull(), got).otherwise(F.raise_error(
        F.concat(F.lit(f"malformed {typ}: "), c)).cast(typ))


def parse_fields(lines: DataFrame, sep: str, fields: list[tuple[str, int, str]],
                 mode: str = "FAILFAST", trim: bool = False) -> DataFrame:
    """Generic delimited parser: ``fields`` = [(name, index, type), ...]."""
    mode = _check_mode(mode)
    parts = F.split(F.col("value"), _literal(sep))
    cols = []
    for name, idx, typ in fields:
        raw = _field(parts, idx, mode)
        if trim:
            raw = F.trim(raw)
        cols.append((raw if typ == "string" else _cast(raw, typ, mode)).alias(name))
    out = lines.select(*cols)
    if mode == "DROPMALFORMED":
        out = out.dropna(how="any")
    return out


def parse_people(lines: DataFrame, mode: str = "FAILFAST") -> DataFrame:
    """``id,name,age,num_friends`` (headerless CSV)."""
    return parse_fields(lines, ",", [("id", 0, "int"), ("name", 1, "string"),
                                     ("age", 2, "int"), ("num_friends", 3, "int")], mode)


def parse_ratings(lines: DataFrame, mode: str = "FAILFAST") -> DataFrame:
    """``user⇥item⇥rating⇥ts`` (the timestamp is kept but never needed)."""
    return parse_fields(lines, "\t", [("user_id", 0, "int"), ("item_id", 1, "int"),
                                      ("rating", 2, "double"), ("ts", 3, "long")], mode)


def parse_readings(lines: DataFrame, mode: str = "FAILFAST") -> DataFrame:
    """``station,date,metric,value[,…]`` weather rows (date unused)."""
    return parse_fields(lines, ",", [("station", 0, "string"), ("metric", 2, "string"),
                                     ("value", 3, "double")], mode)


def parse_customer_orders(lines: DataFrame, mode: str = "FAILFAST") -> DataFrame:
    """``customer,order,amount``; money as exact ``decimal(18,2)``."""
    return parse_fields(lines, ",", [("customer_id", 0, "string"),
                                     ("amount", 2, "decimal(18,2)")], mode)


def parse_labelled_points(lines: DataFrame, mode: str = "FAILFAST") -> DataFrame:
    """``label,feature`` lines -> (label double, x double)."""
    return parse_fields(lines, ",", [("label", 0, "double"), ("x", 1, "double")], mode)


def parse_titles(lines: DataFrame, trim: bool = False, mode: str = "FAILFAST",
                 on_duplicate: str = "keep", ordinal: str | None = None) -> DataFrame:
    """``id|title|…`` -> (item_id long, title string).

    Invalid UTF-8 is replaced (U+FFFD) before splitting; lines with at most
    one field are dropped, as the reference does. ``on_duplicate``:
    ``keep`` (all rows), ``error`` (raise when an id repeats) or ``last``
    (the row with the largest ``ordinal`` wins, e.g. the file position).
    """
    mode = _check_mode(mode)
    # Java's split has no trailing empty fields: "5|" has one field
    value = F.regexp_replace(F.make_valid_utf8(F.col("value")), r"\|+$", "")
    parts = F.split(value, _literal("|"))
    title = parts[1]
    if trim:
        title = F.trim(title)
    keep = [ordinal] if ordinal else []
    out = (lines.where(F.size(parts) > 1)
           .select(_cast(parts[0], "long", mode).alias("item_id"),
                   title.alias("title"), *keep))
    if mode == "DROPMALFORMED":
        out = out.where(F.col("item_id").isNotNull())
    if on_duplicate == "keep":
        return out.select("item_id", "title")
    if on_duplicate == "error":
        g = out.groupBy("item_id").agg(F.count("*").alias("_n"),
                                       F.any_value("title").alias("title"))
        return g.select("item_id", F.when(
            F.col("_n") > 1,
            F.raise_error(F.concat(F.lit("duplicate title id "),
                                   F.col("item_id").cast("string"))))
            .otherwise(F.col("title")).alias("title"))
    if on_duplicate == "last":
        if not ordinal:
            raise ValueError("on_duplicate='last' needs an ordinal column")
        return out.groupBy("item_id").agg(F.max_by("title", ordinal).alias("title"))
    raise ValueError("on_duplicate must be keep, error or last")


def parse_quoted_names(lines: DataFrame, max_id: int | None = None,
                       mode: str = "FAILFAST") -> DataFrame:
    """``id "Name"`` -> (id long, name string).

    Lines without a quote are dropped (P13); the id is trimmed and cast;
    ``max_id`` keeps ids strictly below it (S9's cut-off of dummy rows).
    """
    mode = _check_mode(mode)
    # Java's split has no trailing empty fields
    parts = F.split(F.regexp_replace("value", '"+$', ""), _literal('"'))
    out = (lines.where(F.size(parts) > 1)
           .select(_cast(F.trim(parts[0]), "long", mode).alias("id"),
                   parts[1].alias("name")))
    if mode == "DROPMALFORMED":
        out = out.where(F.col("id").isNotNull())
    if max_id is not None:
        out = out.where(F.col("id") < F.lit(max_id))
    return out


def _tokens(value: Column, pattern: str) -> Column:
    # Java's split drops trailing empties; Spark keeps them: drop all empties
    return F.filter(F.split(F.trim(value), pattern), lambda t: t != F.lit(""))


def parse_adjacency(lines: DataFrame, pattern: str = r"\s+",
                    mode: str = "FAILFAST") -> DataFrame:
    """``id n1 n2 …`` -> edges (src long, dst long), one per entry.

    A node may span several lines; repeated entries stay (a multigraph).
    """
    mode = _check_mode(mode)
    toks = _tokens(F.col("value"), pattern)
    rows = lines.select(toks.alias("_t")).where(F.size("_t") > 0)
    out = rows.select(_cast(F.col("_t")[0], "long", mode).alias("src"),
                      F.explode(F.slice("_t", 2, F.size("_t") - 1)).alias("_d"))
    out = out.select("src", _cast(F.col("_d"), "long", mode).alias("dst"))
    if mode == "DROPMALFORMED":
        out = out.dropna(how="any")
    return out


def adjacency_counts(lines: DataFrame, pattern: str = r"\s+",
                     mode: str = "FAILFAST") -> DataFrame:
    """Per line (id long, n = number of neighbour entries on that line)."""
    mode = _check_mode(mode)
    toks = _tokens(F.col("value"), pattern)
    rows = lines.select(toks.alias("_t")).where(F.size("_t") > 0)
    out = rows.select(_cast(F.col("_t")[0], "long", mode).alias("id"),
                      (F.size("_t") - 1).cast("long").alias("n"))
    if mode == "DROPMALFORMED":
        out = out.dropna(how="any")
    return out


# ---------------------------------------------------------------------------
# Renderers: table rows -> text lines in the formats above. Used to exercise
# the parsers on data Spark derives from the test tables.
# ---------------------------------------------------------------------------

def render_delimited(df: DataFrame, cols: list[str], sep: str) -> DataFrame:
    return df.select(F.concat_ws(sep, *[F.col(c).cast("string") for c in cols]).alias("value"))


def render_quoted_names(df: DataFrame, id_col: str, name_col: str) -> DataFrame:
    return df.select(F.concat(F.col(id_col).cast("string"), F.lit(' "'),
                              F.col(name_col), F.lit('"')).alias("value"))


def render_adjacency(edges: DataFrame, chunk_col: Column) -> DataFrame:
    """Edges -> ``src d1 d2 …`` lines, one line per (src, chunk).

    ``chunk_col`` bounds the entries per line, so a node with a huge
    neighbour list spreads over many lines (the format allows it) and no
    single group grows with the data.
    """
    g = (edges.groupBy("src", chunk_col.alias("_c"))
         .agg(F.collect_list(F.col("dst").cast("string")).alias("_d")))
    return g.select(F.concat_ws(" ", F.col("src").cast("string"), F.array_join("_d", " "))
                    .alias("value"))


# ---------------------------------------------------------------------------
# File readers: the same formats through Spark's CSV reader (column pruning,
# splittable files, native FAILFAST / PERMISSIVE / DROPMALFORMED modes). The
# CSV reader honours double quotes; the line parsers above split literally.
# ---------------------------------------------------------------------------

PEOPLE_SCHEMA = "id int, name string, age int, num_friends int"
RATINGS_SCHEMA = "user_id int, item_id int, rating double, ts long"
READINGS_SCHEMA = "station string, date string, metric string, value double"
CUSTOMER_ORDERS_SCHEMA = "customer_id string, order_id string, amount decimal(18,2)"
LABELLED_SCHEMA = "label double, x double"


def read_delimited(spark: SparkSession, path: str, schema: str, sep: str = ",",
                   mode: str = "FAILFAST") -> DataFrame:
    """Headerless delimited file with an explicit schema (no inference).
    Extra trailing fields are ignored; a short or non-numeric row follows
    ``mode`` for the columns a query reads (Spark parses only selected
    columns, so a bare ``count()`` checks none)."""
    return (spark.read.schema(schema).option("sep", sep).option("header", "false")
            .option("mode", _check_mode(mode)).csv(path))


def read_people(spark: SparkSession, path: str, mode: str = "FAILFAST") -> DataFrame:
    return read_delimited(spark, path, PEOPLE_SCHEMA, ",", mode)


def read_ratings(spark: SparkSession, path: str, mode: str = "FAILFAST") -> DataFrame:
    return read_delimited(spark, path, RATINGS_SCHEMA, "\t", mode)


def read_readings(spark: SparkSession, path: str, mode: str = "FAILFAST") -> DataFrame:
    return read_delimited(spark, path, READINGS_SCHEMA, ",", mode)


def read_customer_orders(spark: SparkSession, path: str, mode: str = "FAILFAST") -> DataFrame:
    return read_delimited(spark, path, CUSTOMER_ORDERS_SCHEMA, ",", mode)


def read_labelled_points(spark: SparkSession, path: str, mode: str = "FAILFAST") -> DataFrame:
    return read_delimited(spark, path, LABELLED_SCHEMA, ",", mode)


def read_titles(spark: SparkSession, path: str, trim: bool = False,
                on_duplicate: str = "keep", mode: str = "FAILFAST") -> DataFrame:
    """S7 from a file. With ``on_duplicate='last'`` the later line of a
    repeated id wins: ``monotonically_increasing_id`` right after the scan
    grows with the file position (split order), which serves as the
    ordinal."""
    lines = read_lines(spark, path).withColumn("_pos", F.monotonically_increasing_id())
    return parse_titles(lines, trim=trim, mode=mode, on_duplicate=on_duplicate,
                        ordinal="_pos")


def read_quoted_names(spark: SparkSession, path: str, max_id: int | None = None,
                      mode: str = "FAILFAST") -> DataFrame:
    """S8/S9 from a file."""
    return parse_quoted_names(read_lines(spark, path), max_id=max_id, mode=mode)


def read_adjacency(spark: SparkSession, path: str, mode: str = "FAILFAST") -> DataFrame:
    """S11/S12 from a file: (src, dst) edges."""
    return parse_adjacency(read_lines(spark, path), mode=mode)
