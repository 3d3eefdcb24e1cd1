"""Whole jobs: copy one table (J1), copy many in dependency order (J2), with metrics.

``migrate_table``: read -> load rules -> target names -> row id -> staged write -> verify the
count -> quality checks and key checks (K5, K6) on the staged copy -> publish when nothing FAILED.
A copy whose primary key repeats or holds NULL fails, as a target with that key would refuse its rows.
A check that breaks is recorded as FAILED with its message and does not undo the copy.
``migrate_all`` runs the tables level by level, then checks the foreign keys (K7) of the tables that
were published, appends the result rows (Q15) and sums up (Q16, J4). Finished tables are noted in a
ledger under the target, by which a second start of the same session goes on where the first stopped.
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferry.functions import text as X
from ferry.functions.names import column_mapping, sanitize_column_name
from ferry.functions.normalise import normalise
from ferry.operators import keys as K
from ferry.operators.profile import profile_columns
from ferry.operators.schema import jdbc_column_types, target_columns
from ferry.plans.quality import append_results, quality_results, quality_summary, session_id, table_check
from ferry.sources.readers import read_source
from ferry.sources.writers import (_fs, add_row_id, current_path, discard, publish, read_published, version_dir,
                                   write_jdbc, write_staged)

RESULT_SCHEMA = ("table_name string, source_table string, rows_read bigint, rows_written bigint, "
                 "verified boolean, overall_status string, pk_violations bigint, unique_violations bigint, "
                 "orphan_keys bigint, published boolean, seconds double, rows_per_second double, "
                 "check_error string, error string")
RESULT_COLUMNS = [f.split()[0] for f in RESULT_SCHEMA.split(", ")]


def _targets(names) -> list[str]:
    names = [names] if isinstance(names, str) else list(names or [])
    return [sanitize_column_name(n) for n in names]


def _check(spark: SparkSession, cfg: dict, source_text: DataFrame, copy: DataFrame, out: dict, options: dict,
           results_path: str | None, session: str, enforce_key: bool) -> bool:
    """All checks of one copy; False if one FAILED. A check that breaks is recorded, not raised. Key violations
    fail the copy (``enforce_key``); violations of unique indexes are reported."""
    started = time.time()
    try:
        check = table_check(spark, source_text, copy, out["table_name"], **options).checkpoint(eager=True)
        out["overall_status"] = check.first()["overall_status"]
        if results_path:
            append_results(quality_results(check, {out["table_name"]: out["source_table"]}, session, started), results_path)
        if cfg.get("primary_key"):
            out["pk_violations"] = K.pk_violations(copy, _targets(cfg["primary_key"])).count()
            if out["pk_violations"] and enforce_key:
                out["overall_status"] = "FAILED"
        unique = [i for i in cfg.get("indexes") or [] if i.get("unique")]
        if unique:
            out["unique_violations"] = sum(K.unique_violations(copy, _targets(i["columns"])).count() for i in unique)
        return out["overall_status"] != "FAILED"
    except Exception as exc:
        out["overall_status"], out["check_error"] = "FAILED", f"{type(exc).__name__}: {exc}"
        return True


def migrate_table(spark: SparkSession, cfg: dict, target_root: str, *, sql_dir: str | None = None,
                  run_checks: bool = True, verify: bool = True, drop_existing: bool = True,
                  pairing: str = "sanitized", empty_as_null: bool = False, row_count: bool = True,
                  content: bool = True, max_chars: int = X.TARGET_TEXT_CHARS, read_options: dict | None = None,
                  raw_source: bool = False, snapshot: bool | None = None, results_path: str | None = None,
                  session: str | None = None, enforce_key: bool = True, transform: Callable[[DataFrame], DataFrame] | None = None) -> dict:
    """J1 for one table config; returns the result as a dict (one row of ``RESULT_SCHEMA``).

    ``snapshot`` writes the normalised source once and both copies and checks that (default: for JDBC
    sources, which may change between two reads). ``raw_source`` compares with the read-stage text instead
    of the load-stage text. ``transform`` is applied to the target frame before the write (a mask, a
    repair). ``enforce_key=False`` publishes a copy in spite of key violations. ``cfg["target"]`` of format ``jdbc`` is written after the checks passed, in batches of ``batch_size``.
    """
    start = time.time()
    name = cfg["target_table"]
    out = dict.fromkeys(RESULT_COLUMNS) | {"table_name": name, "source_table": cfg["source_table"], "published": False}
    run = version_dir(f"{target_root}/{name}")
    kept = f"{target_root}/_staging/{name}-{uuid.uuid4().hex[:12]}"
    try:
        source = read_source(spark, cfg, sql_dir)
        text = normalise(source, "load", max_chars, **(read_options or {}))
        compared = normalise(source, "read", **(read_options or {})) if raw_source else text
        if snapshot if snapshot is not None else cfg.get("source", {}).get("format") == "jdbc":
            write_staged(text, kept)
            text = spark.read.parquet(kept)
            compared = compared if raw_source else text
        mapping = column_mapping(text.columns)
        target = add_row_id(text.toDF(*[mapping[c] for c in text.columns]))
        out["rows_read"] = rows = write_staged(transform(target) if transform else target, run)
        staged = spark.read.parquet(run)
        ok = True
        if verify:
            out["rows_written"] = staged.count()
            out["verified"] = ok = out["rows_written"] == rows
        if ok and run_checks:
            ok = _check(spark, cfg, compared, staged, out, {"pairing": pairing, "empty_as_null": empty_as_null,
                                                             "row_count": row_count, "content": content},
                        results_path, session or session_id(), enforce_key)
        if ok:
            to = cfg.get("target") or {}
            if to.get("format") == "jdbc":
                types = jdbc_column_types(target_columns(profile_columns(source, normalise(source, "read")),
                                                         to.get("mode", "strings")))
                write_jdbc(staged, to["url"], name, to.get("properties"), cfg.get("batch_size") or 1000, drop_existing, types)
            publish(spark, run, f"{target_root}/{name}", drop_existing=drop_existing)
            out["published"] = True
        else:
            discard(spark, run)
    except Exception as exc:  # one table failing must not stop the run (J2)
        out["error"] = f"{type(exc).__name__}: {exc}"
        discard(spark, run)
    discard(spark, kept)
    out["seconds"] = round(time.time() - start, 3)
    if out["rows_read"] and out["seconds"]:
        out["rows_per_second"] = out["rows_read"] / out["seconds"]
    return out


def config_parents(cfgs: list[dict]) -> dict[str, set[str]]:
    """D1 over table configs: the referenced tables of each. Rejects duplicate targets and, as D2,
    references to tables that are not configured."""
    targets = [c["target_table"] for c in cfgs]
    dups = sorted({t for t in targets if targets.count(t) > 1})
    if dups:
        raise ValueError(f"target tables configured more than once: {dups}")
    parents = {c["target_table"]: {fk["referenced_table"] for fk in c.get("foreign_keys") or []} for c in cfgs}
    missing = sorted(set().union(*parents.values()) - set(targets)) if parents else []
    if missing:
        raise ValueError(f"missing referenced tables: {missing}")
    return parents


def load_levels(cfgs: list[dict]) -> list[tuple[str, int]]:
    """D4 for a config list (a few dozen names, so a plain loop): (table, level), parents first. Where a
    cycle blocks all tables left, the one with the smallest name among those on it goes first (D5)."""
    left, out, level = {t: p - {t} for t, p in config_parents(cfgs).items()}, [], 0
    while left:
        ready = sorted(t for t, p in left.items() if not p & left.keys())
        if not ready:
            def reaches(t: str) -> set[str]:
                seen, todo = set(), [t]
                while todo:
                    new = left[todo.pop()] & left.keys() - seen
                    seen |= new
                    todo += new
                return seen
            ready = [min(t for t in left if t in reaches(t))]
        out += [(t, level) for t in ready]
        left = {t: p for t, p in left.items() if t not in ready}
        level += 1
    return out


def load_order(cfgs: list[dict]) -> list[str]:
    return [t for t, _ in load_levels(cfgs)]


def orphan_keys(spark: SparkSession, cfg: dict, published: set[str], target_root: str) -> int | None:
    """K7 over published copies: foreign-key values of one table that its parents do not have; None
    if a parent was not published."""
    fks = cfg.get("foreign_keys") or []
    if any(fk["referenced_table"] not in published for fk in fks):
        return None
    child = read_published(spark, f"{target_root}/{cfg['target_table']}")
    return sum(K.fk_orphans(child, _targets(fk["column"]), read_published(spark, f"{target_root}/{fk['referenced_table']}"),
                            _targets(fk["referenced_column"])).count() for fk in fks)


def ledger_dir(target_root: str, session: str) -> str:
    return f"{target_root}/_runs/{session}"


def _config_digest(cfg: dict) -> str:
    return hashlib.sha256(json.dumps(cfg, sort_keys=True, default=str).encode()).hexdigest()


def note_finished(spark: SparkSession, cfg: dict, target_root: str, session: str, row: dict) -> None:
    """Write one table's result, the version it published and its config to the ledger of the session."""
    version = current_path(spark, f"{target_root}/{cfg['target_table']}")
    entry = row | {"version": version, "config": _config_digest(cfg)}
    path, fs = _fs(spark, f"{ledger_dir(target_root, session)}/{cfg['target_table']}.json")
    out = fs.create(path, True)
    out.write(bytearray((json.dumps(entry) + "\n").encode()))
    out.close()


def finished_tables(spark: SparkSession, cfgs: list[dict], target_root: str, session: str) -> dict[str, dict]:
    """Results of the tables this session has published and checked already: their config is the same and
    the version they published is still the target's. Anything else (also a torn entry) is done again."""
    folder, fs = _fs(spark, ledger_dir(target_root, session))
    if not fs.exists(folder):
        return {}
    rows = spark.read.schema(f"{RESULT_SCHEMA}, version string, config string").json(folder.toString()).collect()
    digests = {c["target_table"]: _config_digest(c) for c in cfgs}
    return {r["table_name"]: {k: r[k] for k in RESULT_COLUMNS} for r in rows
            if r["published"] and not r["error"] and not r["check_error"] and digests.get(r["table_name"]) == r["config"]
            and r["version"] == current_path(spark, f"{target_root}/{r['table_name']}")}


def migrate_all(spark: SparkSession, cfgs: list[dict], target_root: str, parallel_tables: int = 4,
                **options) -> DataFrame:
    """Every configured table, parents before children; one failure does not stop the rest.

    Tables of one dependency level do not reference each other, so up to ``parallel_tables`` of
    them run at once (concurrent Spark jobs from driver threads); the next level starts when the
    level is done. Foreign keys are checked after all loads, between tables that were published.
    Returns one result row per table (a frame of table-count size).

    A run that was stopped is restarted with its ``session``: tables its ledger holds are not copied again,
    the others are, and their result rows replace earlier ones. A new session copies everything.
    """
    by_name = {c["target_table"]: c for c in cfgs}
    options = {"session": session_id(), **options}
    levels: dict[int, list[str]] = {}
    for table, level in load_levels(cfgs):
        levels.setdefault(level, []).append(table)
    session = options["session"]
    finished = finished_tables(spark, cfgs, target_root, session)
    results = []

    def one(table: str) -> dict:
        if table in finished:
            return finished[table]
        row = migrate_table(spark, by_name[table], target_root, **options)
        if row["published"]:
            note_finished(spark, by_name[table], target_root, session, row)
        return row

    with ThreadPoolExecutor(max_workers=max(1, parallel_tables)) as pool:
        for level in sorted(levels):
            results += list(pool.map(one, levels[level]))
        published = {r["table_name"] for r in results if r["published"]}
        done = [r for r in results if r["published"]]
        for r, n in zip(done, pool.map(lambda r: orphan_keys(spark, by_name[r["table_name"]], published, target_root), done)):
            r["orphan_keys"] = n
    return spark.createDataFrame([tuple(r[k] for k in RESULT_COLUMNS) for r in results], RESULT_SCHEMA)


def check_summary(results: DataFrame) -> DataFrame:
    """Q16 over the tables of a run."""
    return quality_summary(results)


def run_summary(results: DataFrame) -> DataFrame:
    """J4 totals: tables, succeeded, rows, seconds, success rate."""
    ok = (F.col("error").isNull()) & F.col("published")
    return results.agg(F.count(F.lit(1)).cast("bigint").alias("total_tables"),
                       F.count_if(ok).cast("bigint").alias("successful_tables"),
                       F.sum("rows_read").cast("bigint").alias("rows_read"),
                       F.sum("seconds").alias("seconds")) \
        .withColumn("success_rate", F.col("successful_tables") * 100.0 / F.col("total_tables"))

