"""Where a table's files are, and how the catalog is pointed to new ones.

Every rewrite goes to a fresh folder; readers see it only once it is complete,
because the catalog is then pointed to it:

* a whole table by one ``ALTER TABLE .. SET LOCATION``;
* partitions one by one, each by one call. What is being switched is noted in
  a table property first, so a switch that a crash cuts short is finished by
  the next look-up (``settle``);
* a table whose columns or layout change has a successor table. A property of
  the successor names the table it becomes, and is set just before that table
  leaves the catalog, so a crash in between is finished the same way. A
  reader may miss the table for that moment; Spark has no single call that
  changes a table's columns and its location.

Tables and folders are known by properties alone, never by a name's form. The
files that a rewrite replaces stay until the next rewrite of the table, so a
query that is still reading them can end.
"""

from __future__ import annotations

import json
import posixpath
import uuid
from collections.abc import Mapping, Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.session import delete_folder

CLUSTER_PROPERTY = "ledgerline.cluster_by"
#: The folder that holds all generations of a table's files.
FILES = "ledgerline.files"
#: A partition switch that has begun: its folder and the slice whose other partitions go.
SWITCH = "ledgerline.switch"
#: On a successor: the table it is made for, and from the swap on the table it becomes.
MADE_FOR, BECOMES = "ledgerline.made_for", "ledgerline.becomes"
#: A file that lists the folders which the last rewrite replaced.
RETIRED = "ledgerline.retired"
DEFAULT_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def sql_value(v: object) -> str:
    if v is None:
        return "NULL"
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


def partition_spec(values: Mapping[str, object]) -> str:
    return ", ".join(f"`{k}` = {sql_value(v)}" for k, v in values.items())


def qualified(spark: SparkSession, table: str) -> str:
    return table if "." in table else f"{spark.catalog.currentDatabase()}.{table}"


# --- properties and folders ------------------------------------------------------

def properties(spark: SparkSession, table: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}


def set_properties(spark: SparkSession, table: str, **values: str | None) -> None:
    """Set the properties (dots written as ``__``), or unset those that are None."""
    named = {k.replace("__", "."): v for k, v in values.items()}
    kept = ", ".join(f"{sql_value(k)} = {sql_value(v)}" for k, v in named.items() if v is not None)
    gone = ", ".join(sql_value(k) for k, v in named.items() if v is None)
    if kept:
        spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({kept})")
    if gone:
        spark.sql(f"ALTER TABLE {table} UNSET TBLPROPERTIES IF EXISTS ({gone})")


def _hadoop(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _location(spark: SparkSession, what: str) -> str:
    # of a partition: its own comes first, the table's follows
    return spark.sql(f"DESCRIBE TABLE EXTENDED {what}").filter("col_name = 'Location'").first()["data_type"]


def location(spark: SparkSession, table: str) -> str:
    return _location(spark, table)


def files_folder(spark: SparkSession, table: str) -> str:
    """The folder for all generations of ``table``: as noted with it, else a new one beside it."""
    if spark.catalog.tableExists(table):
        noted = properties(spark, table).get(FILES)
        if noted:
            return noted
    db, _, name = qualified(spark, table).rpartition(".")
    return posixpath.join(spark.catalog.getDatabase(db).locationUri, f"{name}-{uuid.uuid4().hex[:8]}.files")


def adopt(spark: SparkSession, table: str) -> str:
    """The folder for the files of an existing ``table``, noted with it if it had none."""
    folder = files_folder(spark, table)
    if FILES not in properties(spark, table):
        set_properties(spark, table, ledgerline__files=folder)
    return folder


def fresh(folder: str) -> str:
    return posixpath.join(folder, uuid.uuid4().hex)


# --- partitions -------------------------------------------------------------------

def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def _values(name: str) -> dict[str, str | None]:
    """``a=1/b=x%2Fy`` -> its values."""
    found = dict(part.split("=", 1) for part in name.split("/"))
    return {unquote(k): None if v == DEFAULT_PARTITION else unquote(v) for k, v in found.items()}


def partition_folders(spark: SparkSession, folder: str, columns: Sequence[str]) -> list[tuple[dict, str]]:
    """(values, path) of every partition written under ``folder``."""
    fs, top = _hadoop(spark, posixpath.join(folder, *["*=*"] * len(columns)))
    found = [s.getPath().toString() for s in fs.globStatus(top) or [] if s.isDirectory()]
    return [(_values("/".join(p.split("/")[-len(columns):])), p) for p in found]


def catalog_partitions(spark: SparkSession, table: str, within: Mapping[str, object] | None = None) -> list[dict]:
    """The partitions that the catalog lists (of the slice ``within``)."""
    spec = f" PARTITION ({partition_spec(within)})" if within else ""
    return [_values(r["partition"]) for r in spark.sql(f"SHOW PARTITIONS {table}{spec}").collect()]


def _partition_location(spark: SparkSession, table: str, values: Mapping[str, object]) -> str:
    return _location(spark, f"{table} PARTITION ({partition_spec(values)})")


# --- switching ----------------------------------------------------------------------

def _retire(spark: SparkSession, table: str, paths: Sequence[str]) -> None:
    """Delete the files that the rewrite before this one replaced, and note those that this one did."""
    noted = properties(spark, table)
    if FILES not in noted or not paths:
        return
    before, note = noted.get(RETIRED), fresh(noted[FILES]) + ".retired"
    fs, p = _hadoop(spark, note)
    out = fs.create(p)
    out.write(bytearray("\n".join(paths).encode()))
    out.close()
    set_properties(spark, table, ledgerline__retired=note)
    if before:
        live = {location(spark, table)}
        for r in spark.read.text(before).collect():       # one line per partition rewritten at a time
            if r["value"] not in live:
                delete_folder(spark, r["value"])
        delete_folder(spark, before)


def switch_table(spark: SparkSession, table: str, folder: str) -> None:
    """Point an unpartitioned ``table`` to the complete files in ``folder``: one catalog call."""
    old = location(spark, table)
    spark.sql(f"ALTER TABLE {table} SET LOCATION {sql_value(folder)}")
    spark.catalog.refreshTable(table)
    _retire(spark, table, [old])


def switch_partitions(spark: SparkSession, table: str, folder: str, gone: Mapping[str, object] | None) -> None:
    """Point the partitions in ``folder`` to their files there, each by one catalog call.

    Partitions of the slice ``gone`` that the folder lacks are dropped (of the
    whole table if it is empty, none if it is None).
    """
    noted = {"folder": folder, "gone": None if gone is None else {k: None if v is None else str(v) for k, v in gone.items()}}
    set_properties(spark, table, ledgerline__switch=json.dumps(noted))
    _finish_switch(spark, table, noted)


def _finish_switch(spark: SparkSession, table: str, noted: Mapping) -> None:
    columns = partition_columns(spark, table)
    new = {tuple(v[c] for c in columns): path for v, path in partition_folders(spark, noted["folder"], columns)}
    there = {tuple(v[c] for c in columns) for v in catalog_partitions(spark, table)}
    named = lambda key: dict(zip(columns, key))
    old = []
    for key in new.keys() & there:
        before = _partition_location(spark, table, named(key))
        if before.rstrip("/") != new[key].rstrip("/"):
            spark.sql(f"ALTER TABLE {table} PARTITION ({partition_spec(named(key))}) SET LOCATION {sql_value(new[key])}")
            old.append(before)
    if added := new.keys() - there:
        specs = " ".join(f"PARTITION ({partition_spec(named(k))}) LOCATION {sql_value(new[k])}" for k in added)
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {specs}")
    if noted["gone"] is not None:
        dropped = [k for k in there - new.keys() if all(named(k)[c] == v for c, v in noted["gone"].items())]
        old += [_partition_location(spark, table, named(k)) for k in dropped]
        if dropped:
            specs = ", ".join(f"PARTITION ({partition_spec(named(k))})" for k in dropped)
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {specs}")
    set_properties(spark, table, ledgerline__switch=None)
    spark.catalog.refreshTable(table)
    _retire(spark, table, old)


def create(df: DataFrame, table: str, partition_by: Sequence[str] | None, cluster_by: Sequence[str] | None,
           files: str | None = None, **extra: str) -> str:
    """Write ``df`` to a fresh folder and enter it in the catalog as ``table``."""
    spark = df.sparkSession
    folder = files or files_folder(spark, table)
    path = fresh(folder)
    writer = df.write.format("parquet").mode("errorifexists").option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    elif cluster_by:
        writer = writer.clusterBy(*cluster_by)
    writer.saveAsTable(table)
    # read back by rewrites; Spark has no clustering beside partitions
    noted = {"ledgerline__cluster_by": ",".join(cluster_by)} if cluster_by else {}
    set_properties(spark, table, ledgerline__files=folder, **noted, **extra)
    return path


def succeed(df: DataFrame, table: str, partition_by: Sequence[str] | None, cluster_by: Sequence[str] | None) -> None:
    """Replace ``table`` by a table of other columns or layout: a successor takes its name."""
    spark = df.sparkSession
    table = qualified(spark, table)
    noted = properties(spark, table)
    # what was not made here is the catalog's to delete
    old = [location(spark, table)] if FILES in noted else []
    successor = f"{table}_{uuid.uuid4().hex}"
    create(df, successor, partition_by, cluster_by, files_folder(spark, table), ledgerline__made_for=table)
    set_properties(spark, successor, ledgerline__becomes=table)
    _leave(spark, table)
    _take_name(spark, successor, table)
    if noted.get(RETIRED):
        set_properties(spark, table, ledgerline__retired=noted[RETIRED])
    _retire(spark, table, old)


def _leave(spark: SparkSession, table: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {table}")


def _take_name(spark: SparkSession, successor: str, table: str) -> None:
    spark.sql(f"ALTER TABLE {successor} RENAME TO {table}")
    set_properties(spark, table, ledgerline__becomes=None, ledgerline__made_for=None)


def _successors(spark: SparkSession, table: str, key: str) -> list[str]:
    """Tables of the same database whose property ``key`` names ``table``."""
    table = qualified(spark, table)
    db = table.rpartition(".")[0]
    if not spark.catalog.databaseExists(db):
        return []
    found = spark.sql(f"SHOW TABLE EXTENDED IN {db} LIKE '*'").filter(
        ~F.col("isTemporary") & F.col("information").contains(f"{key}={table}")).collect()
    names = [f"{db}.{r['tableName']}" for r in found]
    return [n for n in names if n != table and properties(spark, n).get(key) == table]


def settle(spark: SparkSession, table: str) -> bool:
    """Whether ``table`` is there, after finishing a swap or switch that a crash cut short."""
    if spark.catalog.tableExists(table):
        switch = properties(spark, table).get(SWITCH)
        if switch:
            _finish_switch(spark, table, json.loads(switch))
        return True
    waiting = _successors(spark, table, BECOMES)
    if not waiting:
        return False
    _take_name(spark, waiting[0], qualified(spark, table))
    return True


def drop(spark: SparkSession, table: str) -> None:
    """Drop the table, its successors that never took its name, and the files of both if they were made here."""
    table = qualified(spark, table)
    for t in [*_successors(spark, table, MADE_FOR), table]:
        owned = properties(spark, t).get(FILES) if spark.catalog.tableExists(t) else None
        spark.sql(f"DROP TABLE IF EXISTS {t}")
        if owned:
            delete_folder(spark, owned)
