"""The loader's operators run against the driver tables.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
tables; :data:`ORACLE_SQL` holds, per entry, an independent DuckDB statement
over the same parquet files that must return the same rows. Operators whose
input is a file format (CSV, fixed width, DBF, a catalog table, a stream)
first write the driver rows in that format into a fresh folder under the
shared work folder (``spark.checkpoint.dir``), then scan it back.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.functions.coerce import apply_spec, jdbc_safe
from lakeloom.functions.keys import key_prefix, normalised_key
from lakeloom.functions.provenance import file_name_attrs, with_source_file
from lakeloom.functions.text import parse_state_list
from lakeloom.operators.contents import coverage_status_by_content, file_contents, landed_contents, record_landed
from lakeloom.operators.integrity import compare_copies, fk_report, pk_report
from lakeloom.operators.ledger import ForeignKeyLedger, KeyLedger
from lakeloom.operators.lookup import lookup_enrich
from lakeloom.operators.manifest import (RANK_EXISTS, RANK_IGNORED, RANK_SUCCESS, any_new_data,
                                         coverage_status_ranked, landed_as_raw,
                                         period_state_grid_rows, skip_landed)
from lakeloom.operators.star import StarEdge, star_join
from lakeloom.plans.loads import load_dimension, load_fact, municipality_dimension
from lakeloom.session import scratch_path
from lakeloom.sinks.targets import Target, create_if_absent, publish_zone, read, write
from lakeloom.sources.catalog import read_table, register_external_table, replace_columns
from lakeloom.sources.csv import read_declared_csv, read_inferred_csv
from lakeloom.sources.dbf import dbf_fields, encode_dbf, encode_memos, read_dbf
from lakeloom.sources.fixed_width import (LOOKUP_ENCODING, MUNICIPALITY_LAYOUT,
                                          fixed_width_file_report, fixed_width_rejects,
                                          read_fixed_width)
from lakeloom.sources.quarantine import FolderLoad, load_fixed_width_folder
from lakeloom.sources.static_dims import STATIC_DIMENSIONS, static_dimension
from lakeloom.streaming.landing import land_new_files

Query = Callable[[SparkSession, str], DataFrame]


_SCHEMAS: dict[str, T.StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table. Its schema is inferred from the parquet footers on
    the first read and supplied on later reads (no second inference)."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    known = _SCHEMAS.get(path)
    if known is not None:
        return spark.read.schema(known).parquet(path)
    df = spark.read.parquet(path)
    _SCHEMAS[path] = df.schema
    return df


def stored(df: DataFrame, name: str) -> DataFrame:
    """A small result written to the work folder, so that what it was made
    from can go."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# --------------------------------------------------------------------------
# Provenance, file-name attributes, sink-safe projection
# --------------------------------------------------------------------------

def source_file(spark: SparkSession, sf: str) -> DataFrame:
    li = with_source_file(table(spark, sf, "lineitem"))
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "arquivo_origem")


def _order_file_names(spark: SparkSession, sf: str, level: str = "nation") -> DataFrame:
    """One raw file name per order: RD + customer's nation (or region) + yyMM."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate",
                                          "o_orderstatus", "o_orderpriority")
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf, "nation").select("n_nationkey", "n_name", "n_regionkey")
    j = o.join(c, o.o_custkey == c.c_custkey).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    if level == "region":
        r = table(spark, sf, "region").select("r_regionkey", "r_name")
        j = j.join(r, F.col("n_regionkey") == F.col("r_regionkey"))
        place = F.upper(F.trim("r_name"))
    else:
        place = F.upper("n_name")
    # format the calendar date, not a timestamp: independent of the session
    # time zone
    yymm = F.date_format(F.col("o_orderdate").cast("date"), "yyMM")
    return j.select("o_orderkey", "o_orderstatus", "o_orderpriority",
                    F.concat(F.lit("RD"), place, yymm).alias("stem"))


def filename_attrs(spark: SparkSession, sf: str) -> DataFrame:
    names = _order_file_names(spark, sf).select(
        "o_orderkey", F.concat("stem", F.lit(".csv")).alias("file_name"))
    # the fixture's places are nation names, not two-letter states
    attrs = file_name_attrs("file_name", pattern=r"^RD(.+?)([0-9]{2})(0[1-9]|1[0-2])\.[^.]+$")
    return names.select("o_orderkey", "file_name", *[v.alias(k) for k, v in attrs.items()])


def jdbc_safe_query(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.array("l_linenumber", "l_suppkey").alias("line_supp"))
    return jdbc_safe(li)


# --------------------------------------------------------------------------
# B4-B6 + C1: key prefix lookup; L2 municipality dimension
# --------------------------------------------------------------------------

def prefix_lookup(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer").select("c_custkey")
    n = table(spark, sf, "nation")
    c = c.withColumn("cod_ibge_uf", key_prefix("c_custkey"))
    return lookup_enrich(c, n, F.col("cod_ibge_uf"), normalised_key(n["n_nationkey"]),
                         n["n_name"], "uf")


def municipality_dim(spark: SparkSession, sf: str) -> DataFrame:
    """L2 end to end: municipalities and states published to a raw zone as
    CSV, scanned back with inferred types, then enriched."""
    root = scratch_path(spark, "raw-zone")
    cust = table(spark, sf, "customer")
    nat = table(spark, sf, "nation")
    paths = publish_zone({
        "raw/ibge-municipios/": cust.select(F.col("c_custkey").alias("id"),
                                            F.col("c_custkey").alias("cod_ibge"),
                                            F.col("c_name").alias("municipio")),
        "raw/ibge-uf/": nat.select(F.col("n_nationkey").alias("id"),
                                   F.col("n_nationkey").alias("cod_ibge"),
                                   F.col("n_name").alias("nome")),
    }, root)
    mun = read_inferred_csv(spark, paths["raw/ibge-municipios/"])
    uf = read_inferred_csv(spark, paths["raw/ibge-uf/"])
    dim = municipality_dimension(mun, uf)
    return dim.select(F.col("id").cast("bigint").alias("id"),
                      F.col("cod_ibge").cast("bigint").alias("cod_ibge"),
                      "municipio", "cod_ibge_uf", "uf")


# --------------------------------------------------------------------------
# Fixed-width text
# --------------------------------------------------------------------------

def _write_lines(spark: SparkSession, lines: DataFrame, name: str) -> str:
    path = scratch_path(spark, name)
    # the text sink writes each string's bytes as they are; encoding to
    # Latin-1 first makes the files what the lookup files are
    lines.select(F.encode("line", LOOKUP_ENCODING).cast("string").alias("line")).write.text(path)
    return path


def _lpad(c: Column, n: int) -> Column:
    return F.lpad(c.cast("string"), n, " ")


def _customer_lines(c: DataFrame, id_text: Column, cod_text: Column, *carry: str) -> DataFrame:
    name = F.concat(F.when(F.col("c_mktsegment") == "BUILDING", F.lit(" ")).otherwise(F.lit("")),
                    F.col("c_name"), F.lit(", "), F.col("c_mktsegment"))
    line = F.concat(_lpad(id_text, 7), F.lit("  "), _lpad(cod_text, 6), F.lit(" "),
                    F.rpad(name, 43, " "), F.lit("   \t"))
    return c.select(line.alias("line"), *carry)


def fixed_width(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as municipality-layout lines (embedded comma, leading
    spaces, blank code where the balance is negative), parsed back."""
    c = table(spark, sf, "customer")
    cod = F.when(F.col("c_acctbal") < 0, F.lit("")).otherwise(F.col("c_nationkey").cast("string"))
    path = _write_lines(spark, _customer_lines(c, F.col("c_custkey"), cod), "fixed-width")
    return read_fixed_width(spark, path, MUNICIPALITY_LAYOUT, encoding=LOOKUP_ENCODING)


def strict_int_rows(spark: SparkSession, sf: str) -> DataFrame:
    """As :func:`fixed_width` with invalid integers: a non-numeric id
    (negative balance) or a code with a thousands comma (automobile
    segment) rejects the line; signs and leading zeros are accepted."""
    path = _strict_int_fixture(spark, sf)
    return read_fixed_width(spark, path, MUNICIPALITY_LAYOUT, encoding=LOOKUP_ENCODING)


def _strict_int_fixture(spark: SparkSession, sf: str) -> str:
    c = table(spark, sf, "customer")
    key = F.col("c_custkey").cast("string")
    nat = F.col("c_nationkey").cast("string")
    id_text = F.when(F.col("c_acctbal") < 0, F.concat(F.lit("x"), key)).otherwise(key)
    cod = (F.when(F.col("c_mktsegment") == "AUTOMOBILE", F.concat(nat, F.lit(",000")))
           .when(F.col("c_mktsegment") == "MACHINERY", F.concat(F.lit("+"), nat))
           .when(F.col("c_mktsegment") == "FURNITURE", F.lpad(nat, 6, "0"))
           .otherwise(nat))
    return _write_lines(spark, _customer_lines(c, id_text, cod), "strict-int")


def fixed_width_rejects_query(spark: SparkSession, sf: str) -> DataFrame:
    """The audit trail of :func:`strict_int_rows`: every rejected line."""
    path = _strict_int_fixture(spark, sf)
    return fixed_width_rejects(spark, path, MUNICIPALITY_LAYOUT, encoding=LOOKUP_ENCODING).select("line")


def fixed_width_audit(spark: SparkSession, sf: str) -> DataFrame:
    """Per-file counts of the strict-int fixture, folded over its files
    (Spark names the part files): lines, kept, rejected, blank."""
    path = _strict_int_fixture(spark, sf)
    per_file = fixed_width_file_report(spark, path, MUNICIPALITY_LAYOUT, encoding=LOOKUP_ENCODING)
    return per_file.agg(*[F.sum(c).cast("bigint").alias(c)
                          for c in ("lines", "kept", "rejected", "blank")])


def _folder_with_bad_files(spark: SparkSession, sf: str) -> FolderLoad:
    """Customers as lookup files of 50 each, plain and compressed, some of
    them with bytes that are no text, cut off, or with invalid integers."""
    import gzip

    folder = f"{scratch_path(spark, 'folder')}/files"
    c = table(spark, sf, "customer")
    id_text = F.when(F.col("c_custkey") % 500 == 77, F.lit("x1")).otherwise(F.col("c_custkey").cast("string"))
    lines = _customer_lines(c.where("c_custkey IS NOT NULL"), id_text, F.col("c_nationkey").cast("string"), "c_custkey")
    of_file = F.floor(F.col("c_custkey") / 50).cast("bigint")

    def write_file(key, pdf):
        from lakeloom import fs as lfs
        k = int(key[0])
        data = "".join(x + "\n" for x in pdf.sort_values("c_custkey")["line"]).encode("utf-8")
        name = f"c{k:08d}.cnv"
        if k % 5 == 1:
            data = data.replace(b"Customer", b"Cust\xffmer", 1)
        if k % 5 in (2, 3):
            name, data = name + ".gz", gzip.compress(data, mtime=0)
        if k % 5 == 2:
            data = data[:len(data) // 2]
        fs, p = lfs.resolve(f"{folder}/{name}")
        fs.create_dir(p.rsplit("/", 1)[0], recursive=True)
        with fs.open_output_stream(p, compression=None) as out:
            out.write(data)
        return pd.DataFrame({"n": [len(pdf)]})

    lines.groupBy(of_file.alias("k")).applyInPandas(write_file, "n long").write.format("noop").mode("overwrite").save()
    return load_fixed_width_folder(spark, folder, MUNICIPALITY_LAYOUT, encoding="UTF-8")


def folder_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of the files that could be read, none of the others."""
    return _folder_with_bad_files(spark, sf).rows


def folder_report(spark: SparkSession, sf: str) -> DataFrame:
    """What became of every file."""
    return _folder_with_bad_files(spark, sf).report


# --------------------------------------------------------------------------
# CSV scans and lenient typing
# --------------------------------------------------------------------------

EVENT_SPEC = [("event_id", "bigint"), ("user_id", "bigint"), ("event_type", "bigint"),
              ("value", "double"), ("props", "bigint")]


def lenient_cast(spark: SparkSession, sf: str) -> DataFrame:
    """Events as raw text, retyped by a declared spec: text in a bigint
    column becomes NULL, the row stays."""
    e = table(spark, sf, "events")
    raw = e.select(*[F.col(n).cast("string").alias(n) for n, _ in EVENT_SPEC])
    return apply_spec(raw, EVENT_SPEC)


LINEITEM_CSV_SPEC = [("orderkey", "bigint"), ("partkey", "bigint"), ("linenumber", "bigint"),
                     ("quantity", "double"), ("returnflag", "bigint"), ("linestatus", "string"),
                     ("extendedprice", "double")]


def lenient_cast_mixed(spark: SparkSession, sf: str) -> DataFrame:
    """A column of which some values are numbers and others not (B9): amounts
    as they are, with a unit, with a decimal comma, with blanks, empty."""
    e = table(spark, sf, "events")
    v = F.col("user_id").cast("string")
    raw = (F.when(F.col("event_id") % 5 == 0, v).when(F.col("event_id") % 5 == 1, F.concat(v, F.lit(" kg")))
           .when(F.col("event_id") % 5 == 2, F.concat(v, F.lit(",5"))).when(F.col("event_id") % 5 == 3, F.concat(F.lit(" "), v))
           .otherwise(F.lit("")))
    texts = e.select("event_id", raw.alias("whole"), F.concat(raw, F.lit(".25")).alias("part"))
    return apply_spec(texts, [("whole", "bigint"), ("part", "double")], keep_extra=True)


def declared_csv(spark: SparkSession, sf: str) -> DataFrame:
    """Line items published as CSV under their own header names, scanned
    back under a declared spec that renames by position and declares the
    return flag bigint (so it reads NULL)."""
    li = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_returnflag",
        "l_linestatus", "l_extendedprice")
    path = scratch_path(spark, "declared-csv")
    write(li, Target.path(path, "csv"))
    return read_declared_csv(spark, path, LINEITEM_CSV_SPEC)


CONVERSATION_SPEC = [("conv", "bigint"), ("turn", "int"), ("said", "string"), ("by", "string"), ("turn_text", "bigint")]


def csv_line_breaks(spark: SparkSession, sf: str) -> DataFrame:
    """Conversations published as CSV with quotes, separators, blanks and
    line breaks of both kinds in their texts, scanned back by position."""
    c = table(spark, sf, "conversations")
    said = F.concat(F.lit(' "'), F.col("role"), F.lit('",\n\n'), F.col("text"), F.lit(' ,"\r\n'), F.col("text"), F.lit("\n "))
    path = scratch_path(spark, "csv-line-breaks")
    write(c.select("conv_id", "turn", F.when(F.col("turn") % 3 == 0, F.col("text")).otherwise(said).alias("said"),
                   "role", F.col("text").alias("turn_text")), Target.path(path, "csv"))
    return read_declared_csv(spark, path, CONVERSATION_SPEC)


def schema_drift(spark: SparkSession, sf: str) -> DataFrame:
    """Events delivered in three drops that each write their own layout: the
    second reorders the columns, upper-cases them and has properties with line
    breaks, the third lacks the type, adds a column and has wider numbers and
    times instead of dates. Read as one table by name."""
    e = table(spark, sf, "events").withColumn("drop", F.col("event_id") % 3)
    day = F.date_format(F.col("ts").cast("date"), "yyyy-MM-dd")
    root = scratch_path(spark, "schema-drift")
    first = e.where("drop = 0").select("event_id", "event_type", (F.col("user_id") % 100).alias("amount"), "props",
                                       day.alias("seen"))
    second = e.where("drop = 1").select(day.alias("SEEN"), F.concat(F.lit("a\n"), "props").alias("PROPS"),
                                        (F.col("user_id") + 3_000_000_000).alias("Amount"), F.col("event_id").alias("EVENT_ID"),
                                        F.col("event_type").alias("Event_Type"))
    third = e.where("drop = 2").select("event_id", (F.col("user_id") + 0.5).alias("amount"), "props",
                                       F.concat(day, F.lit(" 12:30:00")).alias("seen"), F.col("user_id").alias("added"))
    for k, part in enumerate((first, second, third)):
        write(part, Target.path(f"{root}/drop-{k}", "csv"))
    return (read_inferred_csv(spark, f"{root}/drop-*")
            .select(F.col("event_id").cast("bigint").alias("event_id"), "event_type", "amount", "props",
                    F.date_format("seen", "yyyy-MM-dd HH:mm:ss").alias("seen"), F.col("added").cast("bigint").alias("added")))


def inferred_csv(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer")
    path = scratch_path(spark, "inferred-csv")
    write(c.toDF(*[x.upper() for x in c.columns]), Target.path(path, "csv"))
    df = read_inferred_csv(spark, path)
    return df.withColumn("c_custkey", F.col("c_custkey").cast("bigint"))


# --------------------------------------------------------------------------
# Manifest and coverage
# --------------------------------------------------------------------------

def manifest_grid(spark: SparkSession, sf: str) -> DataFrame:
    """Expected files for every month the orders span, for every region: the
    period comes from one aggregation over the orders, the states are the
    rows of the region table."""
    period = table(spark, sf, "orders").agg(
        F.trunc(F.min("o_orderdate").cast("date"), "month").alias("first"),
        F.trunc(F.max("o_orderdate").cast("date"), "month").alias("last"))
    states = table(spark, sf, "region").select(F.concat(F.lit(" "), F.lower("r_name")).alias("uf"))
    return period_state_grid_rows(period, states)


def state_lists(spark: SparkSession, sf: str) -> DataFrame:
    """Comma lists of states as users write them, one per order priority and
    status, taken apart (B12)."""
    o = table(spark, sf, "orders").select("o_orderkey", F.concat(
        F.lit(" "), F.lower(F.substring("o_orderpriority", 3, 10)), F.lit(" ,, "), F.col("o_orderstatus"), F.lit(",")).alias("text"))
    return o.select("o_orderkey", F.array_join(parse_state_list("text"), "|").alias("states"))


def _landed_names(spark: SparkSession, sf: str) -> DataFrame:
    """Raw-zone file names implied by the orders: finished orders landed as
    ``.csv``, urgent ones as ``.CSV``, pending ones left ``.tmp`` files."""
    names = _order_file_names(spark, sf, "region")
    ext = (F.when(F.col("o_orderstatus") == "F", F.lit(".csv"))
           .when(F.col("o_orderpriority") == "1-URGENT", F.lit(".CSV"))
           .when(F.col("o_orderstatus") == "P", F.lit(".tmp")))
    return names.filter(ext.isNotNull()).select(F.concat("stem", ext).alias("file_name"))


def skip_landed_query(spark: SparkSession, sf: str) -> DataFrame:
    return skip_landed(manifest_grid(spark, sf), landed_as_raw(_landed_names(spark, sf)))


def _status_ranks(spark: SparkSession, sf: str) -> DataFrame:
    """Best status rank per raw file: skip list (urgent orders) before
    staged (finished) before arrived (open). The order-to-region join runs
    once and is folded to one row per file name."""
    rank = (F.when(F.col("o_orderpriority") == "1-URGENT", F.lit(RANK_IGNORED))
            .when(F.col("o_orderstatus") == "F", F.lit(RANK_EXISTS))
            .when(F.col("o_orderstatus") == "O", F.lit(RANK_SUCCESS)))
    return (_order_file_names(spark, sf, "region")
            .select(F.concat("stem", F.lit(".dbc")).alias("file_name"), rank.alias("rank"))
            .filter(F.col("rank").isNotNull())
            .groupBy("file_name").agg(F.min("rank").alias("rank")))


def coverage_status_query(spark: SparkSession, sf: str) -> DataFrame:
    return coverage_status_ranked(manifest_grid(spark, sf), _status_ranks(spark, sf))


def coverage_summary(spark: SparkSession, sf: str) -> DataFrame:
    return (coverage_status_query(spark, sf).groupBy("status")
            .agg(F.count(F.lit(1)).alias("n_files")))


def any_new_data_query(spark: SparkSession, sf: str) -> DataFrame:
    return any_new_data(coverage_status_query(spark, sf))


def content_status(spark: SparkSession, sf: str) -> DataFrame:
    """Files of 50 customers each in two drops: some come again unchanged,
    some with other content of the same length, some only once; one name per
    nation never comes."""
    root = scratch_path(spark, "contents")
    c = table(spark, sf, "customer").select("c_custkey", F.floor(F.col("c_custkey") / 50).cast("bigint").alias("k"),
                                            F.col("c_acctbal").cast("string").alias("v"))

    def drop(name: str, rows: DataFrame, changed: bool) -> DataFrame:
        folder = f"{root}/{name}"

        def write_file(key, pdf):
            from lakeloom import fs as lfs
            k = int(key[0])
            data = "".join(f"{a};{v}\n" for a, v in sorted(zip(pdf["c_custkey"], pdf["v"])))
            if changed and k % 4 == 1:
                data = data[:-1] + "!"
            fs, p = lfs.resolve(f"{folder}/f{k}.csv")
            fs.create_dir(p.rsplit("/", 1)[0], recursive=True)
            with fs.open_output_stream(p) as out:
                out.write(data.encode())
            return pd.DataFrame({"n": [len(pdf)]})

        rows.groupBy("k").applyInPandas(write_file, "n long").write.format("noop").mode("overwrite").save()
        return file_contents(spark, folder, chunk=256)

    record_landed(spark, f"{root}/ledger", drop("d1", c.where("k % 4 <> 0"), False), "1")
    arrived = drop("d2", c.where("k % 4 <> 3"), True)
    grid = c.select(F.concat(F.lit("f"), F.col("k").cast("string"), F.lit(".csv")).alias("file_name")).distinct().unionByName(
        table(spark, sf, "nation").select(F.concat(F.lit("n"), F.col("n_nationkey").cast("string"), F.lit(".csv")).alias("file_name")))
    skip = grid.where("file_name = 'n3.csv'")
    return coverage_status_by_content(grid, skip, landed_contents(spark, f"{root}/ledger"), arrived)


# --------------------------------------------------------------------------
# Integrity reports
# --------------------------------------------------------------------------

def fk_report_query(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem")
    orders = table(spark, sf, "orders")
    dims = {
        "orders": orders,
        "open_orders": orders.filter(F.col("o_orderstatus") == "O"),
        "part": table(spark, sf, "part"),
        "supplier": table(spark, sf, "supplier"),
    }
    edges = [("l_orderkey", "orders", "o_orderkey"),
             ("l_orderkey", "open_orders", "o_orderkey"),
             ("l_partkey", "part", "p_partkey"),
             ("l_suppkey", "supplier", "s_suppkey")]
    return fk_report(li, edges, dims)


PK_CHECKS = [("orders", "o_orderkey"), ("orders", "o_custkey"),
             ("lineitem", ["l_orderkey", "l_linenumber"]), ("customer", "c_custkey"),
             ("part", "p_partkey"), ("supplier", "s_suppkey"), ("nation", "n_nationkey"),
             ("region", "r_regionkey")]


def pk_report_query(spark: SparkSession, sf: str) -> DataFrame:
    return pk_report([(name, table(spark, sf, name), pk) for name, pk in PK_CHECKS])


def _ledger_name(spark: SparkSession) -> str:
    return "lakeloom_ledger_" + scratch_path(spark, "ledger").rsplit("-", 1)[-1]


def pk_increments(spark: SparkSession, sf: str) -> DataFrame:
    """Orders and line items arrive in three drops, the second one twice;
    every drop is checked against a key ledger. Customers repeat in orders."""
    out = None
    for name, key in (("orders", "o_orderkey"), ("orders", "o_custkey"), ("lineitem", ["l_orderkey", "l_linenumber"])):
        rows = table(spark, sf, name)
        ledger = KeyLedger(spark, _ledger_name(spark), key, buckets=8)
        by = F.col(name[0] + "_orderkey") % 3
        for k in (0, 1, 1, 2):
            ledger.add(rows.where(by == k), f"d{k}")
        got = stored(ledger.report(name), "pk-increments")
        ledger.remove()
        out = got if out is None else out.unionByName(got)
    return out


def fk_increments(spark: SparkSession, sf: str) -> DataFrame:
    """Line items in two drops, their orders in two drops that come late: an
    orphan of the first drop finds its order in the second. The last orders
    never come."""
    li, orders = table(spark, sf, "lineitem"), table(spark, sf, "orders")
    dim = KeyLedger(spark, _ledger_name(spark), "o_orderkey", buckets=8)
    fact = ForeignKeyLedger(spark, _ledger_name(spark), "l_orderkey", dim)
    dim.add(orders.where("o_orderkey % 4 = 0"), "d1")
    fact.add(li.where("l_linenumber <= 2"), "d1")
    dim.add(orders.where("o_orderkey % 4 IN (1, 2)"), "d2")
    fact.add(li.where("l_linenumber > 2"), "d2")
    out = stored(fact.report("orders"), "fk-increments")
    fact.remove()
    dim.remove()
    return out


# --------------------------------------------------------------------------
# Star join; flagship
# --------------------------------------------------------------------------

def star_join_query(spark: SparkSession, sf: str) -> DataFrame:
    li = with_source_file(table(spark, sf, "lineitem")).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "arquivo_origem")
    edges = [
        StarEdge("l_partkey", table(spark, sf, "part"), "p_partkey", "part", ("p_name", "p_brand")),
        StarEdge("l_suppkey", table(spark, sf, "supplier"), "s_suppkey", "supp",
                 ("s_name", "s_nationkey")),
        StarEdge("l_orderkey", table(spark, sf, "orders"), "o_orderkey", "ord",
                 ("o_orderstatus", "o_orderpriority")),
    ]
    return star_join(li, edges)


def static_dim_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """A static dimension used as a lookup on a fact code: each line
    number resolved against the specialty list (unknown codes NULL)."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    espec = static_dimension(spark, "dim_espec")
    return lookup_enrich(li, espec, F.col("l_linenumber").cast("bigint"), espec["cod"],
                         espec["espec"], "espec")


# --------------------------------------------------------------------------
# publishing
# --------------------------------------------------------------------------

def fact_load(spark: SparkSession, sf: str) -> DataFrame:
    """L3 on line items: tagged, published as staging and fact, read back."""
    root = scratch_path(spark, "fact-load")
    scan = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    staging, fact = Target.path(f"{root}/st"), Target.path(f"{root}/fat")
    dims = {"part": table(spark, sf, "part"), "supplier": table(spark, sf, "supplier")}
    load_fact(spark, scan, staging, fact, dims,
              edges=[("l_partkey", "part", "p_partkey"), ("l_suppkey", "supplier", "s_suppkey")])
    return spark.read.parquet(fact.location)


def fact_reports(spark: SparkSession, sf: str) -> DataFrame:
    """What a fact load reports: its foreign keys (part keys over a hundred
    have no dimension row here) beside whether staging and fact are the same."""
    root = scratch_path(spark, "fact-reports")
    scan = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    staging, fact = Target.path(f"{root}/st", "csv"), Target.path(f"{root}/fat")
    dims = {"part": table(spark, sf, "part").where("p_partkey <= 100"), "supplier": table(spark, sf, "supplier")}
    keys = load_fact(spark, scan, staging, fact, dims,
                     edges=[("l_partkey", "part", "p_partkey"), ("l_suppkey", "supplier", "s_suppkey")])
    same = compare_copies(read(spark, staging, read(spark, fact).schema), read(spark, fact))
    return keys.crossJoin(F.broadcast(same.drop("ok")))  # one row


def dimension_load(spark: SparkSession, sf: str) -> DataFrame:
    """Dimensions loaded twice: the first load writes and checks keys, the
    second finds them there. Orders by customer have repeated keys."""
    root = scratch_path(spark, "dimension-load")
    out = None
    for name, key in (("customer", "c_custkey"), ("part", "p_partkey"), ("orders", "o_custkey")):
        for k in (1, 2):
            got = load_dimension(spark, lambda name=name: table(spark, sf, name), Target.path(f"{root}/{name}"), name, key)
            got = got.withColumn("load", F.lit(k))
            out = got if out is None else out.unionByName(got)
    return out


def atomic_refresh(spark: SparkSession, sf: str) -> DataFrame:
    """A refresh that breaks on its way leaves what the first load published."""
    target = Target.path(scratch_path(spark, "atomic-refresh"), versioned=True)
    c = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    write(c, target)
    balance = F.when(F.col("c_custkey") % 97 == 5, F.raise_error(F.lit("planted fault")).cast("double"))
    try:
        write(c.withColumn("c_acctbal", balance.otherwise(F.col("c_acctbal") + 1)), target)
    except Exception as exc:  # noqa: BLE001 - the planted fault alone
        if "planted fault" not in str(exc):
            raise
    return read(spark, target)


def single_winner(spark: SparkSession, sf: str) -> DataFrame:
    """Two loaders at once over a folder that an earlier load left half
    written: every customer is there once."""
    from concurrent.futures import ThreadPoolExecutor

    from lakeloom import hadoop
    target = Target.path(scratch_path(spark, "single-winner"))
    c = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    write(c.where("c_custkey % 2 = 0"), target)
    hadoop.delete(spark, f"{target.location}/_SUCCESS")
    with ThreadPoolExecutor(2) as pool:
        won = list(pool.map(lambda _: create_if_absent(spark, target, lambda: c), range(2)))
    return read(spark, target).withColumn("winners", F.lit(sum(won)))


def replace_columns_query(spark: SparkSession, sf: str) -> DataFrame:
    """A table partitioned by segment, registered with text columns, gets typed
    ones without its location, keys or options being named again."""
    c = table(spark, sf, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    place = scratch_path(spark, "replace-columns")
    write(c, Target.path(place, "csv", partition_by=("c_mktsegment",)))
    name = "lakeloom_replace_" + place.rsplit("-", 1)[-1]
    register_external_table(spark, name, place, [("a", "string"), ("b", "string"), ("c_mktsegment", "string")],
                            partition_by=["c_mktsegment"])
    return replace_columns(spark, name, [("custkey", "bigint"), ("acctbal", "double")])


def create_if_absent_query(spark: SparkSession, sf: str) -> DataFrame:
    """The first load wins: a second, different load of an existing target
    is skipped and leaves the rows as they were."""
    target = Target.path(scratch_path(spark, "create-if-absent"))
    c = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    create_if_absent(spark, target, lambda: c)
    create_if_absent(spark, target, lambda: c.withColumn("c_acctbal", F.col("c_acctbal") + 1))
    return spark.read.parquet(target.location)


ORDERS_SPEC = [("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"),
               ("o_totalprice", "double")]


def register_table_query(spark: SparkSession, sf: str) -> DataFrame:
    """Orders published to a zone in two batches (finished, then the rest),
    registered as one external CSV table and scanned as one table."""
    o = table(spark, sf, "orders").select(*[n for n, _ in ORDERS_SPEC])
    root = scratch_path(spark, "zone")
    paths = publish_zone({"raw/orders/": o.filter(F.col("o_orderstatus") == "F")}, root)
    write(o.filter(~F.col("o_orderstatus").eqNullSafe("F")), Target.path(paths["raw/orders/"], "csv"),
          mode="append")
    name = "lakeloom_orders_" + root.rsplit("-", 1)[-1]
    register_external_table(spark, name, paths["raw/orders/"], ORDERS_SPEC)
    return read_table(spark, name)


PARTY_SPEC = [("key", "bigint"), ("name", "string"), ("nationkey", "bigint"), ("acctbal", "double")]


def zone_publish(spark: SparkSession, sf: str) -> DataFrame:
    """Customers and suppliers published to one zone root, each under its
    own sub-folder, then read back through the path map with one declared
    spec."""
    c = table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal")
    s = table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    paths = publish_zone({"raw/customer/": c, "raw/supplier/": s}, scratch_path(spark, "zone-pub"))
    parts = [read_declared_csv(spark, path, PARTY_SPEC).withColumn("zone_table", F.lit(sub))
             for sub, path in paths.items()]
    return parts[0].unionByName(parts[1])


# --------------------------------------------------------------------------
# DBF
# --------------------------------------------------------------------------

# DBF field names hold at most 10 characters
CUSTOMER_DBF = [("c_custkey", "N", 10, 0), ("c_name", "C", 25, 0),
                ("c_nation", "N", 4, 0), ("c_acctbal", "N", 14, 2)]


def _write_customer_dbf(spark: SparkSession, c: DataFrame, folder: str) -> None:
    """One DBF file per Arrow batch of each partition; customers with a
    negative balance are written as deleted records."""
    fields = dbf_fields(CUSTOMER_DBF)
    names = [f[0] for f in CUSTOMER_DBF]
    c = c.withColumnRenamed("c_nationkey", "c_nation")

    def write_files(batches):
        from pyspark import TaskContext

        from lakeloom import fs as lfs
        # names depend on partition and batch only, so a retried task
        # overwrites its own files instead of adding copies
        pid = TaskContext.get().partitionId()
        for i, pdf in enumerate(batches):
            if pdf.empty:
                continue
            rows = list(pdf[names].itertuples(index=False, name=None))
            deleted = (pdf["c_acctbal"] < 0).tolist()
            data = encode_dbf(rows, fields, deleted=deleted)
            fs, p = lfs.resolve(f"{folder}/part-{pid:05d}-{i:05d}.dbf")
            fs.create_dir(p.rsplit("/", 1)[0], recursive=True)
            with fs.open_output_stream(p) as out:
                out.write(data)
            yield pd.DataFrame({"n": [len(rows)]})

    c.select(*names).mapInPandas(write_files, "n long").write.format("noop").mode("overwrite").save()


def dbf_scan(spark: SparkSession, sf: str) -> DataFrame:
    folder = scratch_path(spark, "dbf")
    _write_customer_dbf(spark, table(spark, sf, "customer"), folder)
    # small ranges so every file is read by several tasks
    df = read_dbf(spark, folder, partition_bytes=64 * 1024)
    return df.withColumnRenamed("c_nation", "c_nationkey")


ORDER_DBF = [("okey", "N", 10, 0), ("wide", "N", 20, 0), ("price", "Y", 8, 4), ("total", "B", 8, 0),
             ("placed", "T", 8, 0), ("status", "C", 12, 0), ("note", "M", 4, 0)]


def dbf_typed(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as FoxPro tables with wide whole numbers, currency, doubles and
    times in binary and notes in memo files, in code page 850; every third
    order has no note. Files lie in sub-folders by year."""
    folder = f"{scratch_path(spark, 'dbf-typed')}/tables"
    fields = dbf_fields(ORDER_DBF)
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderdate", "o_orderstatus", "o_orderpriority")

    def write_files(batches):
        from pyspark import TaskContext

        from lakeloom import fs as lfs
        pid = TaskContext.get().partitionId()
        for i, pdf in enumerate(batches):
            for year, part in pdf.groupby(pdf["o_orderdate"].dt.year):
                notes = [None if k % 3 == 0 else f"nº {k}\r\n{p} ç".encode("cp850") * (1 + k % 3)
                         for k, p in zip(part["o_orderkey"].tolist(), part["o_orderpriority"])]
                memo, at = encode_memos(notes)
                rows = [(k, k + 12345678901234567890, x, x / 3, d.to_pydatetime(), f"é{s}", n or None)
                        for k, x, d, s, n in zip(part["o_orderkey"].tolist(), part["o_totalprice"].tolist(),
                                                 part["o_orderdate"], part["o_orderstatus"], at)]
                data = encode_dbf(rows, fields, encoding="cp850", version=0x30, code_page=0x02)
                for ext, content in (("dbf", data), ("fpt", memo)):
                    fs, p = lfs.resolve(f"{folder}/{year}/part-{pid:05d}-{i:05d}.{ext}")
                    fs.create_dir(p.rsplit("/", 1)[0], recursive=True)
                    with fs.open_output_stream(p) as out:
                        out.write(content)
            yield pd.DataFrame({"n": [len(pdf)]})

    o.mapInPandas(write_files, "n long").write.format("noop").mode("overwrite").save()
    df = read_dbf(spark, folder, partition_bytes=256 * 1024, recursive=True)
    return df.select("okey", F.col("wide").cast("string").alias("wide"), F.col("price").cast("string").alias("price"), "total",
                     F.date_format("placed", "yyyy-MM-dd HH:mm:ss").alias("placed"), "status", "note")


# --------------------------------------------------------------------------
# streaming landing
# --------------------------------------------------------------------------

def stream_landing(spark: SparkSession, sf: str) -> DataFrame:
    """Orders arrive as CSV files in two drops; each landing run takes only
    files it has not taken before, so the landed table has every order
    exactly once."""
    o = table(spark, sf, "orders").select(*[n for n, _ in ORDERS_SPEC])
    root = scratch_path(spark, "landing")
    raw, out, ckpt = f"{root}/raw", f"{root}/landed", f"{root}/_checkpoint"
    write(o.filter(F.col("o_orderstatus") == "F"), Target.path(raw, "csv"))
    land_new_files(spark, raw, ORDERS_SPEC, out, ckpt)
    write(o.filter(~F.col("o_orderstatus").eqNullSafe("F")), Target.path(raw, "csv"), mode="append")
    land_new_files(spark, raw, ORDERS_SPEC, out, ckpt)
    land_new_files(spark, raw, ORDERS_SPEC, out, ckpt)  # nothing new: lands nothing
    return spark.read.parquet(out).select(*[n for n, _ in ORDERS_SPEC])


QUERIES: dict[str, Query] = {
    "source_file": source_file,
    "filename_attrs": filename_attrs,
    "jdbc_safe": jdbc_safe_query,
    "prefix_lookup": prefix_lookup,
    "municipality_dim": municipality_dim,
    "fixed_width": fixed_width,
    "strict_int_rows": strict_int_rows,
    "fixed_width_rejects": fixed_width_rejects_query,
    "fixed_width_audit": fixed_width_audit,
    "folder_rows": folder_rows,
    "folder_report": folder_report,
    "lenient_cast": lenient_cast,
    "lenient_cast_mixed": lenient_cast_mixed,
    "declared_csv": declared_csv,
    "csv_line_breaks": csv_line_breaks,
    "schema_drift": schema_drift,
    "inferred_csv": inferred_csv,
    "manifest_grid": manifest_grid,
    "state_lists": state_lists,
    "content_status": content_status,
    "skip_landed": skip_landed_query,
    "coverage_status": coverage_status_query,
    "coverage_summary": coverage_summary,
    "any_new_data": any_new_data_query,
    "fk_report": fk_report_query,
    "pk_report": pk_report_query,
    "pk_increments": pk_increments,
    "fk_increments": fk_increments,
    "star_join": star_join_query,
    "static_dim_lookup": static_dim_lookup,
    "fact_load": fact_load,
    "fact_reports": fact_reports,
    "dimension_load": dimension_load,
    "atomic_refresh": atomic_refresh,
    "single_winner": single_winner,
    "replace_columns": replace_columns_query,
    "create_if_absent": create_if_absent_query,
    "register_table": register_table_query,
    "zone_publish": zone_publish,
    "dbf_scan": dbf_scan,
    "dbf_typed": dbf_typed,
    "stream_landing": stream_landing,
}


# --------------------------------------------------------------------------
# DuckDB oracles
# --------------------------------------------------------------------------

def _sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _espec_values() -> str:
    rows = next(r for t, _, _, r in STATIC_DIMENSIONS if t == "dim_espec")
    return ", ".join(f"({cod}, {_sql_str(txt)})" for cod, txt in rows)


_ORDER_STEMS = """
  SELECT o.o_orderkey, o.o_orderstatus, o.o_orderpriority,
         'RD' || upper(trim(r.r_name)) || strftime(o.o_orderdate, '%y%m') AS stem
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
"""

_GRID = """
  WITH p AS (
    SELECT CAST(date_trunc('month', min(o_orderdate)) AS DATE) AS s,
           CAST(date_trunc('month', max(o_orderdate)) AS DATE) AS e FROM orders),
  m AS (SELECT CAST(unnest(generate_series(s, e, INTERVAL 1 MONTH)) AS DATE) AS month FROM p),
  mi AS (SELECT month, row_number() OVER (ORDER BY month) - 1 AS mi FROM m),
  st AS (SELECT upper(trim(lower(r_name))) AS uf,
                row_number() OVER (ORDER BY lower(r_name)) - 1 AS si FROM region),
  ns AS (SELECT count(*) AS ns FROM region)
  SELECT CAST(mi.mi * ns.ns + st.si AS INTEGER) AS seq, st.uf,
         CAST(year(mi.month) AS INTEGER) AS ano, CAST(month(mi.month) AS INTEGER) AS mes,
         strftime(mi.month, '%y%m') AS aamm,
         'RD' || st.uf || strftime(mi.month, '%y%m') || '.dbc' AS file_name
  FROM mi, st, ns
"""

_COVERAGE = f"""
  WITH grid AS ({_GRID}),
  s AS ({_ORDER_STEMS}),
  ig AS (SELECT DISTINCT stem || '.dbc' AS file_name FROM s WHERE o_orderpriority = '1-URGENT'),
  ex AS (SELECT DISTINCT stem || '.dbc' AS file_name FROM s WHERE o_orderstatus = 'F'),
  ok AS (SELECT DISTINCT stem || '.dbc' AS file_name FROM s WHERE o_orderstatus = 'O')
  SELECT g.*, CASE WHEN g.file_name IN (SELECT file_name FROM ig) THEN 'ignored'
                   WHEN g.file_name IN (SELECT file_name FROM ex) THEN 'exists'
                   WHEN g.file_name IN (SELECT file_name FROM ok) THEN 'success'
                   ELSE 'error' END AS status
  FROM grid g
"""


def _fk_sql(fk: str, dim: str, dim_from: str, key: str) -> str:
    orphans = (f"FROM lineitem f WHERE f.{fk} IS NOT NULL AND NOT EXISTS "
               f"(SELECT 1 FROM {dim_from} d WHERE CAST(d.{key} AS VARCHAR) = CAST(f.{fk} AS VARCHAR))")
    return f"""
  SELECT '{fk}' AS fk_column, '{dim}' AS dim_table, '{key}' AS dim_key,
         (SELECT count(*) {orphans}) AS orphan_rows,
         (SELECT count(DISTINCT f.{fk}) {orphans}) AS orphan_keys,
         (SELECT count(*) = count(DISTINCT {key}) AND count({key}) = count(*) FROM {dim_from} d) AS target_unique,
         (SELECT count(*) {orphans}) = 0 AS ok"""


def _pk_sql(name: str, pk) -> str:
    keys = [pk] if isinstance(pk, str) else list(pk)
    null_any = " OR ".join(f"{k} IS NULL" for k in keys)
    return f"""
  SELECT '{name}' AS table_name, '{",".join(keys)}' AS pk,
         CAST(sum(n) AS BIGINT) AS n_rows,
         CAST(coalesce(sum(CASE WHEN nul THEN n END), 0) AS BIGINT) AS null_key_rows,
         CAST(count(CASE WHEN NOT nul AND n > 1 THEN 1 END) AS BIGINT) AS duplicate_keys,
         CAST(coalesce(sum(CASE WHEN NOT nul AND n > 1 THEN n END), 0) AS BIGINT) AS duplicate_rows,
         coalesce(sum(CASE WHEN nul THEN n END), 0) = 0
           AND count(CASE WHEN NOT nul AND n > 1 THEN 1 END) = 0 AS ok
  FROM (SELECT ({null_any}) AS nul, count(*) AS n FROM {name} GROUP BY {", ".join(keys)})"""


def _customer_name_sql() -> str:
    return ("CASE WHEN c_mktsegment = 'BUILDING' THEN ' ' ELSE '' END || c_name || '  ' "
            "|| c_mktsegment")


ORACLE_SQL: dict[str, str] = {
    "source_file": """
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 'lineitem.parquet' AS arquivo_origem
  FROM lineitem""",
    "filename_attrs": """
  WITH f AS (
    SELECT o.o_orderkey, 'RD' || upper(n.n_name) || strftime(o.o_orderdate, '%y%m') || '.csv' AS file_name,
           CAST(strftime(o.o_orderdate, '%y') AS INTEGER) AS yy
    FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
    JOIN nation n ON c.c_nationkey = n.n_nationkey)
  SELECT o_orderkey, file_name,
         regexp_extract(file_name, '^RD(.+?)([0-9]{2})([0-9]{2})\\.[^.]+$', 1) AS uf,
         CAST(CASE WHEN yy <= 68 THEN 2000 + yy ELSE 1900 + yy END AS INTEGER) AS ano,
         CAST(regexp_extract(file_name, '^RD(.+?)([0-9]{2})([0-9]{2})\\.[^.]+$', 3) AS INTEGER) AS mes
  FROM f""",
    "jdbc_safe": """
  SELECT l_orderkey, l_linenumber, CAST([CAST(l_linenumber AS BIGINT), l_suppkey] AS VARCHAR) AS line_supp
  FROM lineitem""",
    "prefix_lookup": """
  WITH d AS (SELECT trim(CAST(n_nationkey AS VARCHAR)) AS k, min(n_name) AS uf FROM nation GROUP BY 1)
  SELECT c.c_custkey, left(CAST(c.c_custkey AS VARCHAR), 2) AS cod_ibge_uf, d.uf
  FROM customer c LEFT JOIN d ON left(CAST(c.c_custkey AS VARCHAR), 2) = d.k""",
    "municipality_dim": """
  WITH d AS (SELECT trim(CAST(n_nationkey AS VARCHAR)) AS k, min(n_name) AS uf FROM nation GROUP BY 1)
  SELECT c.c_custkey AS id, c.c_custkey AS cod_ibge, c.c_name AS municipio,
         left(CAST(c.c_custkey AS VARCHAR), 2) AS cod_ibge_uf, d.uf
  FROM customer c LEFT JOIN d ON left(CAST(c.c_custkey AS VARCHAR), 2) = d.k""",
    "fixed_width": f"""
  SELECT c_custkey AS id,
         CASE WHEN c_acctbal < 0 THEN NULL ELSE CAST(c_nationkey AS BIGINT) END AS cod_ibge,
         {_customer_name_sql()} AS municipio
  FROM customer""",
    "strict_int_rows": f"""
  SELECT c_custkey AS id, CAST(c_nationkey AS BIGINT) AS cod_ibge, {_customer_name_sql()} AS municipio
  FROM customer WHERE c_acctbal >= 0 AND c_mktsegment <> 'AUTOMOBILE'""",
    "fixed_width_rejects": """
  SELECT lpad(CASE WHEN c_acctbal < 0 THEN 'x' || CAST(c_custkey AS VARCHAR)
                   ELSE CAST(c_custkey AS VARCHAR) END, 7, ' ')
         || '  ' ||
         lpad(CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN CAST(c_nationkey AS VARCHAR) || ',000'
                   WHEN c_mktsegment = 'MACHINERY' THEN '+' || CAST(c_nationkey AS VARCHAR)
                   WHEN c_mktsegment = 'FURNITURE' THEN lpad(CAST(c_nationkey AS VARCHAR), 6, '0')
                   ELSE CAST(c_nationkey AS VARCHAR) END, 6, ' ')
         || ' ' ||
         rpad(CASE WHEN c_mktsegment = 'BUILDING' THEN ' ' ELSE '' END || c_name || ', ' || c_mktsegment,
              43, ' ')
         || e'   \t' AS line
  FROM customer WHERE c_acctbal < 0 OR c_mktsegment = 'AUTOMOBILE'""",
    "fixed_width_audit": """
  SELECT count(*) AS lines,
         count(CASE WHEN c_acctbal >= 0 AND c_mktsegment <> 'AUTOMOBILE' THEN 1 END) AS kept,
         count(CASE WHEN c_acctbal < 0 OR c_mktsegment = 'AUTOMOBILE' THEN 1 END) AS rejected,
         CAST(0 AS BIGINT) AS blank
  FROM customer""",
    "folder_rows": f"""
  SELECT c_custkey AS id, CAST(c_nationkey AS BIGINT) AS cod_ibge, {_customer_name_sql()} AS municipio,
         'c' || lpad(CAST(c_custkey // 50 AS VARCHAR), 8, '0') || CASE WHEN c_custkey // 50 % 5 = 3 THEN '.cnv.gz' ELSE '.cnv' END
           AS file_name
  FROM customer WHERE c_custkey // 50 % 5 NOT IN (1, 2) AND c_custkey % 500 <> 77""",
    "folder_report": """
  WITH f AS (
    SELECT c_custkey // 50 AS k, count(*) AS lines, count(CASE WHEN c_custkey % 500 = 77 THEN 1 END) AS rejected
    FROM customer GROUP BY 1)
  SELECT 'c' || lpad(CAST(k AS VARCHAR), 8, '0') || CASE WHEN k % 5 IN (2, 3) THEN '.cnv.gz' ELSE '.cnv' END AS file_name,
         CASE WHEN k % 5 IN (1, 2) THEN 'failed' WHEN rejected > 0 THEN 'rejected' ELSE 'read' END AS status,
         CASE WHEN k % 5 IN (1, 2) THEN 0 ELSE lines END AS lines,
         CASE WHEN k % 5 IN (1, 2) THEN 0 ELSE lines - rejected END AS kept,
         CASE WHEN k % 5 IN (1, 2) THEN 0 ELSE rejected END AS rejected, CAST(0 AS BIGINT) AS blank,
         CASE k % 5 WHEN 1 THEN '1 lines are not UTF-8' WHEN 2 THEN 'cannot be unpacked: EOFError' END AS reason
  FROM f""",
    "lenient_cast": """
  SELECT event_id, user_id, CAST(NULL AS BIGINT) AS event_type, value,
         TRY_CAST(props AS BIGINT) AS props
  FROM events""",
    "lenient_cast_mixed": """
  SELECT event_id, CASE WHEN event_id % 5 IN (0, 3) THEN user_id END AS whole,
         CASE WHEN event_id % 5 IN (0, 3) THEN user_id + 0.25::DOUBLE WHEN event_id % 5 = 4 THEN 0.25::DOUBLE END AS part
  FROM events""",
    "declared_csv": """
  SELECT l_orderkey AS orderkey, l_partkey AS partkey, CAST(l_linenumber AS BIGINT) AS linenumber,
         l_quantity AS quantity, CAST(NULL AS BIGINT) AS returnflag, l_linestatus AS linestatus,
         l_extendedprice AS extendedprice
  FROM lineitem""",
    "csv_line_breaks": """
  SELECT conv_id AS conv, CAST(turn AS INTEGER) AS turn, role AS "by", CAST(NULL AS BIGINT) AS turn_text,
         CASE WHEN turn % 3 = 0 THEN text
              ELSE ' "' || role || e'",\n\n' || text || e' ,"\r\n' || text || e'\n ' END AS said
  FROM conversations""",
    "schema_drift": """
  SELECT event_id, CASE WHEN event_id % 3 < 2 THEN event_type END AS event_type,
         CASE event_id % 3 WHEN 0 THEN user_id % 100 WHEN 1 THEN user_id + 3000000000 ELSE user_id + 0.5::DOUBLE END AS amount,
         CASE WHEN event_id % 3 = 1 THEN e'a\n' || props ELSE props END AS props,
         strftime(ts, '%Y-%m-%d') || CASE WHEN event_id % 3 = 2 THEN ' 12:30:00' ELSE ' 00:00:00' END AS seen,
         CASE WHEN event_id % 3 = 2 THEN user_id END AS added
  FROM events""",
    "inferred_csv": """
  SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer""",
    "manifest_grid": _GRID,
    "state_lists": """
  SELECT o_orderkey, upper(trim(substr(o_orderpriority, 3, 10))) || '|' || o_orderstatus AS states FROM orders""",
    "content_status": """
  SELECT 'f' || CAST(k AS VARCHAR) || '.csv' AS file_name,
         CASE k % 4 WHEN 0 THEN 'success' WHEN 1 THEN 'changed' ELSE 'exists' END AS status
  FROM (SELECT DISTINCT c_custkey // 50 AS k FROM customer)
  UNION ALL
  SELECT 'n' || CAST(n_nationkey AS VARCHAR) || '.csv', CASE n_nationkey WHEN 3 THEN 'ignored' ELSE 'error' END FROM nation""",
    "skip_landed": f"""
  WITH grid AS ({_GRID}),
  s AS ({_ORDER_STEMS}),
  names AS (
    SELECT stem || CASE WHEN o_orderstatus = 'F' THEN '.csv'
                        WHEN o_orderpriority = '1-URGENT' THEN '.CSV'
                        WHEN o_orderstatus = 'P' THEN '.tmp' END AS name FROM s),
  landed AS (SELECT DISTINCT regexp_replace(name, '\\.[^./]*$', '.dbc') AS file_name
             FROM names WHERE lower(name) LIKE '%.csv')
  SELECT g.* FROM grid g WHERE g.file_name NOT IN (SELECT file_name FROM landed)""",
    "coverage_status": _COVERAGE,
    "coverage_summary": f"""
  SELECT status, count(*) AS n_files FROM ({_COVERAGE}) GROUP BY status""",
    "any_new_data": f"""
  SELECT coalesce(bool_or(status = 'success'), false) AS any_new_data FROM ({_COVERAGE})""",
    "fk_report": " UNION ALL ".join([
        _fk_sql("l_orderkey", "orders", "orders", "o_orderkey"),
        _fk_sql("l_orderkey", "open_orders",
                "(SELECT * FROM orders WHERE o_orderstatus = 'O')", "o_orderkey"),
        _fk_sql("l_partkey", "part", "part", "p_partkey"),
        _fk_sql("l_suppkey", "supplier", "supplier", "s_suppkey"),
    ]),
    "pk_report": " UNION ALL ".join(_pk_sql(n, pk) for n, pk in PK_CHECKS),
    "pk_increments": " UNION ALL ".join(
        _pk_sql(n, pk) for n, pk in (("orders", "o_orderkey"), ("orders", "o_custkey"), ("lineitem", ["l_orderkey", "l_linenumber"]))),
    "fk_increments": _fk_sql("l_orderkey", "orders", "(SELECT * FROM orders WHERE o_orderkey % 4 < 3)", "o_orderkey"),
    "star_join": """
  SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, 'lineitem.parquet' AS arquivo_origem,
         p.p_name AS part_p_name, p.p_brand AS part_p_brand,
         s.s_name AS supp_s_name, s.s_nationkey AS supp_s_nationkey,
         o.o_orderstatus AS ord_o_orderstatus, o.o_orderpriority AS ord_o_orderpriority
  FROM lineitem l
  LEFT JOIN part p ON l.l_partkey = p.p_partkey
  LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
  LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey""",
    "static_dim_lookup": f"""
  WITH e(cod, espec) AS (VALUES {_espec_values()})
  SELECT l.l_orderkey, l.l_linenumber, e.espec
  FROM lineitem l LEFT JOIN e ON CAST(l.l_linenumber AS BIGINT) = e.cod""",
    "fact_load": """
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
         'lineitem.parquet' AS arquivo_origem
  FROM lineitem""",
    "fact_reports": f"""
  SELECT k.*, n AS first_rows, n AS second_rows, CAST(0 AS BIGINT) AS differing_rows FROM (
    {_fk_sql("l_partkey", "part", "(SELECT * FROM part WHERE p_partkey <= 100)", "p_partkey")}
    UNION ALL {_fk_sql("l_suppkey", "supplier", "supplier", "s_suppkey")}) k, (SELECT count(*) AS n FROM lineitem)""",
    "dimension_load": " UNION ALL ".join(
        f"SELECT *, '{action}' AS action, {k} AS load FROM ({_pk_sql(n, pk)})"
        for n, pk in (("customer", "c_custkey"), ("part", "p_partkey"), ("orders", "o_custkey"))
        for k, action in ((1, "written"), (2, "exists"))),
    "atomic_refresh": """
  SELECT c_custkey, c_name, c_acctbal FROM customer""",
    "single_winner": """
  SELECT c_custkey, c_name, c_acctbal, 1 AS winners FROM customer""",
    "replace_columns": """
  SELECT c_custkey AS custkey, c_acctbal AS acctbal, c_mktsegment FROM customer""",
    "create_if_absent": """
  SELECT c_custkey, c_name, c_acctbal FROM customer""",
    "register_table": """
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders""",
    "zone_publish": """
  SELECT c_custkey AS key, c_name AS name, CAST(c_nationkey AS BIGINT) AS nationkey,
         c_acctbal AS acctbal, 'raw/customer/' AS zone_table FROM customer
  UNION ALL
  SELECT s_suppkey, s_name, CAST(s_nationkey AS BIGINT), s_acctbal, 'raw/supplier/' FROM supplier""",
    "dbf_scan": """
  SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal
  FROM customer WHERE c_acctbal >= 0""",
    "dbf_typed": """
  SELECT o_orderkey AS okey, CAST(CAST(o_orderkey AS HUGEINT) + 12345678901234567890 AS VARCHAR) AS wide,
         CAST(CAST(o_totalprice AS DECIMAL(19, 4)) AS VARCHAR) AS price, o_totalprice / 3 AS total,
         strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS placed, 'é' || o_orderstatus AS status,
         CASE WHEN o_orderkey % 3 <> 0 THEN
           repeat('nº ' || CAST(o_orderkey AS VARCHAR) || e'\r\n' || o_orderpriority || ' ç', CAST(1 + o_orderkey % 3 AS INTEGER)) END AS note
  FROM orders""",
    "stream_landing": """
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders""",
}
