"""Sinks for the star (K1-K6).

* ``write_csv``  - one header CSV directory per table (K1)
* ``write_jdbc`` - append / overwrite over JDBC with batching and parallel
  connections (K2, K3); connection options come from the caller (K6)
* ``write_star`` - every table to one target, published together (K4, K5)
* ``write_star_tables`` - build + write in dependency order: dimensions are
  written and read back before the facts are built, so the facts never
  recompute a dimension and the lineage is cut at each written table

Folder targets are versioned (see ``sinks.versions``): a build writes files of
its own and is published by one rename of its manifest.
"""

from __future__ import annotations

import os

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from starloom.operators.lookups import known_bytes, known_rows, remember_bytes, remember_rows
from starloom.operators.registry import as_registry, next_registry
from starloom.plans import checks as star_checks
from starloom.plans import observed
from starloom.plans import star as star_plan
from starloom.session import ensure_checkpoint_dir, run_concurrently
from starloom.sinks.jdbc import append_batch, replace_tables
from starloom.sinks.parts import PART_COLUMNS, write_parts
from starloom.sinks.versions import KEEP, Manifest, PublishConflict, TableEntry, Versions
from starloom.sources.quarantine import Sources, rejection_checks

SORT_ON_WRITE = {"dim_date": ["date"]}


def _path(base: str, name: str) -> str:
    return base.rstrip("/") + "/" + name


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", header: bool = True) -> None:
    """K1: header CSV, no index column; quotes and newlines escaped."""
    (df.write.mode(mode).option("header", header).option("escape", '"')
       .option("quoteAll", False).csv(path))


def jdbc_options(url: str, user: str | None = None, password: str | None = None,
                 driver: str | None = None, batchsize: int = 10_000,
                 num_partitions: int | None = None, **extra) -> dict[str, str]:
    """K6: JDBC options from explicit arguments (read secrets where you keep them)."""
    opts = {"url": url, "batchsize": str(batchsize)}
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    if driver is not None:
        opts["driver"] = driver
    if num_partitions is not None:
        opts["numPartitions"] = str(num_partitions)
    opts.update({k: str(v) for k, v in extra.items()})
    return opts


def write_jdbc(df: DataFrame, table: str, options: dict[str, str], mode: str = "append",
               truncate: bool = False) -> None:
    """K2 (``mode="append"``) and K3 (``mode="overwrite"``; ``truncate`` keeps
    the table definition).  ``numPartitions`` bounds the open connections."""
    w = df.write.format("jdbc").options(**options).option("dbtable", table).mode(mode)
    if truncate:
        w = w.option("truncate", "true")
    w.save()


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by=None) -> None:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


# Facts joined on order_id (items-orders in the revenue report) are bucketed
# alike, so the join reads matching buckets without a shuffle.
DEFAULT_BUCKETS = {"fact_orders": "order_id", "fact_order_items": "order_id",
                   "fact_payments": "order_id"}


def write_table(df: DataFrame, name: str, database: str | None = None, mode: str = "overwrite",
                bucket_by: str | None = None, num_buckets: int | None = None,
                path: str | None = None) -> str:
    """A catalog table (parquet), optionally bucketed and sorted by ``bucket_by``.

    Names are database-qualified, so a temporary view of the same name never
    shadows the table."""
    full = f"{database or df.sparkSession.catalog.currentDatabase()}.{name}"
    n = num_buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if bucket_by:  # one task a bucket: at most one file each, however many tasks feed them
        df = df.repartition(n, bucket_by)
    w = df.write.mode(mode).format("parquet")
    if bucket_by:
        w = w.bucketBy(n, bucket_by).sortBy(bucket_by)
    if path:
        w = w.option("path", path)
    w.saveAsTable(full)
    return full


def _ordered(name: str, df: DataFrame) -> DataFrame:
    cols = SORT_ON_WRITE.get(name)
    return df.orderBy(*cols) if cols else df


def _write_folders(tables: dict[str, DataFrame], folder: str, fmt: str, parallel: int | None = None,
                   mode: str = "errorifexists") -> dict[str, str]:
    """Every table as a folder below ``folder``, as it is, written together."""
    writer = {"parquet": write_parquet, "csv": write_csv}[fmt]
    spark = next(iter(tables.values())).sparkSession if tables else None
    run_concurrently({name: (lambda name=name, df=df: writer(df, _path(folder, name), mode=mode))
                      for name, df in tables.items()}, parallel, spark)
    return {n: _path(folder, n) for n in tables}


def write_star(tables: dict[str, DataFrame], target: str, fmt: str = "parquet",
               jdbc: dict[str, str] | None = None, mode: str = "overwrite",
               staged: bool = True, database: str | None = None,
               buckets: dict[str, str] | None = None,
               num_buckets: int | None = None, parallel: int | None = None,
               keep: int = KEEP) -> dict[str, str]:
    """K4/K5: write every table.  Folder targets are published as the next
    version of ``target``: the tables replace those of the same name, other
    tables of the current version stay as they are, and readers see all of it
    or nothing (``staged=False`` writes plain folders, unversioned).  The table
    writes are independent jobs and are submitted together (``parallel`` bounds
    how many; 1 writes one after another).  ``fmt="table"`` writes catalog
    tables (under ``target`` when given), the facts bucketed by order_id so
    their joins need no shuffle, one at a time.  JDBC tables are loaded beside
    the old ones and exchanged in one transaction (``staged=False``, or an
    append, writes them in place, one at a time).  Returns name -> location or table name."""
    if fmt == "table":
        buckets = DEFAULT_BUCKETS if buckets is None else buckets
        return {name: write_table(df, name, database=database, mode=mode,
                                  bucket_by=buckets.get(name), num_buckets=num_buckets,
                                  path=_path(target, name) if target else None)
                for name, df in tables.items()}
    if fmt == "jdbc":
        if mode == "overwrite" and staged and tables:
            replace_tables(next(iter(tables.values())).sparkSession, {n: _ordered(n, df) for n, df in tables.items()}, jdbc or {})
            return {n: n for n in tables}
        for name, df in tables.items():
            write_jdbc(_ordered(name, df), name, jdbc or {}, mode=mode,
                       truncate=(mode == "overwrite"))
        return {n: n for n in tables}
    tables = {name: _ordered(name, df) for name, df in tables.items()}
    if not staged or not tables:
        return _write_folders(tables, target, fmt, parallel, mode)
    versions = Versions(next(iter(tables.values())).sparkSession, target)
    base, run = versions.current(), versions.new_run()
    try:
        where = _write_folders(tables, versions.path(run), fmt, parallel)
        versions.publish({n: TableEntry([f"{run}/{n}"], df.schema.jsonValue(), fmt) for n, df in tables.items()}, base)
    except Exception:
        versions.fs.delete(versions.path(run))
        raise
    versions.retire(keep)
    return where


SHARED_SOURCES = ("orders", "order_items", "order_reviews", "order_payments")


# Dimension -> (natural key, surrogate key) of those with dense keys.
KEYED = {"dim_customers": ("customer_id", "customer_sk"), "dim_products": ("product_id", "product_sk"),
         "dim_seller": ("seller_id", "seller_sk"), "dim_payments": ("payment_type", "payment_sk")}


#: The table of records that the readers rejected (source, file, reason, record).
QUARANTINE = "quarantine"


def registry_name(dim: str) -> str:
    return f"keys_{dim}"


def write_star_tables(spark: SparkSession, sources: dict[str, DataFrame], target: str,
                      fmt: str = "parquet", persist_shared: bool = False,
                      table_opts: dict | None = None, parallel: int | None = None,
                      stable_keys: bool = False, checks: str = "observed", require: bool = False,
                      incremental: bool = False, keep: int = KEEP, notes: dict | None = None,
                      jdbc: dict[str, str] | None = None, jdbc_names: dict[str, str] | None = None,
                      **build_opts) -> dict[str, DataFrame]:
    """Build and persist the whole star in dependency order; returns the
    written tables (read back for parquet and catalog tables), ready for
    ``spark.sql`` or the analytics.

    Folder targets (parquet, csv): all nine tables are published together as
    the next version of ``target`` by one rename of its manifest, so a refresh
    that fails, or is killed, at any step leaves the previous star whole (never
    new dimensions beside old facts); what a killed one left is removed by a
    later build.  Facts are built from the written parquet dimensions, so they
    never recompute one; for CSV they use the built dimensions, whose keys are
    already checkpointed.  Catalog tables (``fmt="table"``) are overwritten in
    place, dimensions first.

    ``stable_keys`` (parquet, catalog tables) keeps surrogate keys across
    refreshes in a registry per dimension, written beside it as ``keys_<dim>``:
    members keep their key, also when they are absent for a while, and the key
    of a retired member is never given to another.  ``previous=read_star(...)``
    takes the keys from the tables of an earlier star instead.

    ``checks``: rows, null keys and unknown members are counted by the writes
    themselves (``"observed"``); ``"all"`` also holds the written, not yet
    published tables against each other (unique and orphan keys, one scan a
    table).  They are stored in the manifest (``published_checks``).  With
    ``require`` a failing check raises ``StarCheckFailed`` and nothing is
    published.

    ``jdbc`` (connection options, see ``jdbc_options``; parquet) also loads the
    nine tables into a database, as they were published, in one step
    (``sinks.jdbc``); ``jdbc_names`` gives tables another name there
    (``{"fact_order_items": "fact_orders_items"}``).

    ``infer_members=True`` gives keys that facts use and dimensions lack a
    flagged member, and null keys the unknown member (``operators.members``).

    Records that ``load_sources(on_bad="quarantine")`` rejected are published
    with the star as the table ``quarantine``, and counted in the checks.

    ``incremental`` (parquet) cuts facts into days and writes only the days
    whose rows differ from the published version; it implies ``stable_keys``.
    See ``sinks.parts``.

    ``persist_shared=True`` keeps the sources that feed more than one table
    (orders, items, reviews, payments) with MEMORY_AND_DISK for the duration
    of the build, so costly sources (CSV parsing, derived roles) are computed
    once; lost blocks are recomputed from their scan.  Off by default: for
    parquet sources a second scan is cheaper than building the cache.

    Folder targets build each group of dependent tables (a fact with the
    dimensions it looks up: customers and orders; products, sellers and
    items; payment types and payments; the date dimension; reviews) from
    keys to written fact on its own, all groups at the same time, so no
    group waits for another's slowest job.  ``parallel`` bounds how many
    jobs are submitted together (1: one after another).
    """
    table_opts = dict(table_opts or {})
    if fmt not in ("parquet", "csv", "table"):
        raise ValueError("write_star_tables writes parquet or csv folders, or catalog tables")
    if checks not in ("observed", "all"):
        raise ValueError("checks is 'observed' or 'all'")
    if jdbc is not None and fmt != "parquet":
        raise ValueError("a database is loaded from the published parquet tables")
    stable_keys = stable_keys or incremental
    if fmt == "csv" and stable_keys:
        raise ValueError("keys are kept in parquet folders or catalog tables")
    if fmt == "table" and (incremental or require or checks == "all"):
        raise ValueError("catalog tables are overwritten in place: check them with plans.checks afterwards")
    held = []
    if persist_shared:
        sources = Sources(sources, getattr(sources, "rejected", None))
        for name in SHARED_SOURCES:
            if name in sources:
                sources[name] = sources[name].persist(StorageLevel.MEMORY_AND_DISK)
                held.append(sources[name])
    try:
        if fmt == "table":
            dims, facts = _build_in_place(spark, sources, target, table_opts, build_opts, parallel, stable_keys)
        else:
            manifest, dims, facts = _publish(spark, sources, target, fmt, build_opts, parallel, stable_keys,
                                             checks, require, incremental, keep, notes)
    finally:
        for df in held:
            df.unpersist()
    if fmt == "csv":
        return {**dims, **facts}
    if fmt == "table":
        out = read_star(spark, target, names=[*dims, *facts], fmt=fmt, database=table_opts.get("database"))
    else:
        versions = Versions(spark, target)
        out = {n: versions.read(manifest, n) for n in star_plan.TABLES}
        if jdbc is not None:
            replace_tables(spark, {(jdbc_names or {}).get(n, n): df for n, df in out.items()}, jdbc)
    for n, d in dims.items():
        _same_counts(out[n], d)  # exact counts from the key jobs
    return out


def _same_counts(written: DataFrame, built: DataFrame) -> None:
    """What the key jobs counted holds for the written table too."""
    remember_bytes(remember_rows(written, known_rows(built)), known_bytes(built))


def _registries(dims: dict[str, DataFrame], old: dict[str, DataFrame]) -> dict[str, DataFrame]:
    real = lambda n: dims[n].where(f"{KEYED[n][1]} <> {star_checks.UNKNOWN_KEY}")
    return {registry_name(n): next_registry(old.get(n), real(n), *KEYED[n]) for n in KEYED if n in dims}


def _known_keys(versions: Versions, base: Manifest | None) -> dict[str, DataFrame]:
    """The key registries of the published version; a star published without
    them starts its registries from its dimensions."""
    out = {}
    for n, (nk, sk) in KEYED.items():
        if base and registry_name(n) in base.tables:
            out[n] = versions.read(base, registry_name(n))
        elif base and n in base.tables:
            out[n] = as_registry(versions.read(base, n).where(f"{sk} <> {star_checks.UNKNOWN_KEY}"), nk, sk)
    return out


def _publish(spark, sources, target, fmt, build_opts, parallel, stable_keys, checks, require,
             incremental, keep, notes):
    """Folder targets: each group of dependent tables (a fact with the
    dimensions it looks up) is built and written into the build's own run
    folder, groups at the same time; the manifest then publishes all tables
    together, or the run folder is removed."""
    versions = Versions(spark, target)
    versions.recover()
    base = versions.current()
    run = versions.new_run()
    folder = versions.path(run)
    old_keys = _known_keys(versions, base) if stable_keys else {}
    date_lookup = build_opts.get("date_lookup", "computed")
    st = star_plan.Star(sources, build_opts.get("grain", "day"),
                        build_opts.get("include_shipping", True),
                        num_buckets=build_opts.get("num_buckets"),
                        previous=build_opts.get("previous"), registries=old_keys,
                        infer_members=build_opts.get("infer_members", False))
    watch = observed.Watch(sources)
    # counted above the sort: its range sample runs what is below a second time
    watched = lambda tables: {n: watch.table(n, _ordered(n, df)) for n, df in tables.items()}
    entry = lambda n, df: TableEntry([f"{run}/{n}"], df.schema.jsonValue(), fmt, watch.metrics(n))

    def group(dim_names, fact_names):
        st.prepare(dim_names, parallel)
        dims = {n: st[n] for n in dim_names}
        _write_folders(watched(dims), folder, fmt, parallel)
        # facts look up the written dimensions (parquet), never recomputing
        # one; CSV dimensions are used as built (their keys are checkpointed)
        used = ({n: spark.read.schema(d.schema).parquet(_path(folder, n)) for n, d in dims.items()}
                if fmt == "parquet" else dict(dims))
        for n, d in dims.items():
            _same_counts(used[n], d)
        facts = {}
        for n in fact_names:
            facts.update(star_plan.build_facts(watch.fact_sources(n) if not incremental else sources, used,
                                               build_opts.get("null_safe", False), date_lookup, [n],
                                               build_opts.get("infer_members", False)))
        entries = {n: entry(n, d) for n, d in dims.items()}
        if incremental:
            entries.update(run_concurrently(
                {n: (lambda n=n: write_parts(versions, facts[n], n, PART_COLUMNS.get(n), base, run)) for n in facts},
                parallel, spark))
        else:
            _write_folders(watched(facts), folder, fmt, parallel)
            entries.update({n: entry(n, f) for n, f in facts.items()})
        if stable_keys:
            keys = _registries(used, {n: old_keys[n] for n in used if n in old_keys})
            _write_folders(keys, folder, fmt, parallel)
            entries.update({n: TableEntry([f"{run}/{n}"], k.schema.jsonValue(), fmt) for n, k in keys.items()})
        return dims, facts, entries

    try:
        done = run_concurrently({i: (lambda g=g: group(*g))
                                 for i, g in enumerate(star_plan.table_groups(date_lookup))},
                                parallel, spark)
        dims, facts, entries = {}, {}, {}
        for d, f, e in done.values():
            dims.update(d)
            facts.update(f)
            entries.update(e)
        metrics = {n: entries[n].metrics for n in star_plan.TABLES if "rows" in entries[n].metrics}
        rows = observed.observed_checks(metrics, watch.source_rows(metrics))
        if checks == "all":
            made = Manifest(0, entries)
            written = {n: versions.read(made, n) for n in star_plan.TABLES} if fmt == "parquet" else {**dims, **facts}
            kinds = star_checks.KINDS if incremental else ("unique", "orphan_keys")
            rows += [tuple(r) for r in star_checks.checked(sources, written, kinds).collect()]
        rejected = getattr(sources, "quarantine", lambda: None)()
        if rejected is not None:
            _write_folders({QUARANTINE: rejected}, folder, "parquet", parallel)
            entries[QUARANTINE] = TableEntry([f"{run}/{QUARANTINE}"], rejected.schema.jsonValue())
            rows += rejection_checks(versions.read(Manifest(0, entries), QUARANTINE), sources.rejected)
        if require:
            star_checks.assert_rows(rows)
        manifest = versions.publish(entries, base, {**(notes or {}), "checks": rows})
    except Exception:
        versions.fs.delete(folder)  # the published star was never touched
        raise
    versions.retire(keep)
    return (manifest, {n: dims[n] for n in star_plan.DIMENSIONS}, {n: facts[n] for n in star_plan.FACTS})


def _build_in_place(spark, sources, target, table_opts, build_opts, parallel, stable_keys):
    """Catalog tables: dimensions written first, then the facts built from
    them.  Keys of an earlier star are checkpointed before its tables are
    overwritten."""
    db = table_opts.get("database") or spark.catalog.currentDatabase()
    cut = lambda df: (ensure_checkpoint_dir(spark), df.checkpoint(eager=True))[1]
    previous = build_opts.get("previous")
    if previous:
        previous = {n: cut(previous[n].select(*KEYED[n])) for n in KEYED if n in previous}
    old_keys = {}
    if stable_keys:
        for n, (nk, sk) in KEYED.items():
            if spark.catalog.tableExists(f"{db}.{registry_name(n)}"):
                old_keys[n] = cut(spark.table(f"{db}.{registry_name(n)}"))
            elif spark.catalog.tableExists(f"{db}.{n}"):
                old_keys[n] = cut(as_registry(spark.table(f"{db}.{n}").where(f"{sk} <> {star_checks.UNKNOWN_KEY}"), nk, sk))
    dims = star_plan.build_dimensions(sources, build_opts.get("grain", "day"),
                                      build_opts.get("include_shipping", True),
                                      build_opts.get("num_buckets"), previous, parallel, old_keys,
                                      build_opts.get("infer_members", False))
    write_star(dims, target, fmt="table", **table_opts)
    used = read_star(spark, target, names=dims, fmt="table", database=table_opts.get("database"))
    for n, d in dims.items():
        _same_counts(used[n], d)
    if stable_keys:
        write_star(_registries(used, old_keys), target, fmt="table", **table_opts)
    facts = star_plan.build_facts(sources, used, build_opts.get("null_safe", False),
                                  build_opts.get("date_lookup", "computed"),
                                  infer_members=build_opts.get("infer_members", False))
    write_star(facts, target, fmt="table", **table_opts)
    return dims, facts


def read_star(spark: SparkSession, target: str, names=None, fmt: str = "parquet",
              database: str | None = None, schemas: dict | None = None,
              version: int | None = None) -> dict[str, DataFrame]:
    """The written tables.  For a folder: those of its newest version (or of
    ``version``, while it is kept), all of that one version; a folder without
    versions is read as plain table folders (``schemas`` skips their footer
    inference)."""
    schemas = schemas or {}
    if fmt == "table":
        db = database or spark.catalog.currentDatabase()
        return {n: spark.table(f"{db}.{n}") for n in names or star_plan.TABLES}
    versions = Versions(spark, target)
    manifest = versions.load(version) if version is not None else versions.current()
    if manifest is not None:
        return {n: versions.read(manifest, n) for n in names or [t for t in star_plan.TABLES if t in manifest.tables]}
    if fmt == "parquet":
        return {n: (spark.read.schema(schemas[n]) if n in schemas else spark.read).parquet(_path(target, n))
                for n in names or star_plan.TABLES}
    raise ValueError("read back CSV with starloom.sources.read_csv and a schema")


def published_checks(spark: SparkSession, target: str, version: int | None = None) -> DataFrame:
    """The checks stored with a published version; reads its manifest only."""
    versions = Versions(spark, target)
    manifest = versions.load(version) if version is not None else versions.current()
    return observed.check_frame(spark, [tuple(r) for r in (manifest.notes.get("checks", []) if manifest else [])])


def published_counts(spark: SparkSession, target: str, version: int | None = None) -> DataFrame:
    """C1 without a scan: (table_name, row_count) as the writes counted them."""
    versions = Versions(spark, target)
    manifest = versions.load(version) if version is not None else versions.current()
    rows = [(n, t.metrics["rows"]) for n, t in (manifest.tables if manifest else {}).items() if "rows" in t.metrics]
    return spark.createDataFrame(rows, "table_name string, row_count long")


# The name the original database load gives the item fact
# (view name -> table name).
DATABASE_NAMES = {"fact_orders_items": "fact_order_items"}


def register_views(spark: SparkSession, tables: dict[str, DataFrame],
                   aliases: dict[str, str] | None = None) -> None:
    """Expose the tables to ``spark.sql`` under their names, plus each
    ``aliases`` view name for the table it names.  ``aliases=DATABASE_NAMES``
    lets SQL written against the original database load run unchanged.
    (Spark sorts nulls first ascending and last descending, the reverse of
    Postgres: write ``NULLS LAST`` / ``NULLS FIRST`` where it matters.)"""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    for view, name in (aliases or {}).items():
        if name in tables:
            tables[name].createOrReplaceTempView(view)
