"""The three jobs over files: daily mention run, text backfill, risk digest.

Each job reads its inputs with the sources, builds one lazy plan and writes
with the sinks. ``python -m riskfeed.plans.jobs <daily|backfill|digest> ...``
runs one job; every path may be local or any file system the cluster mounts.
"""

from __future__ import annotations

import argparse
from dataclasses import dataclass

from pyspark.sql import Observation, SparkSession
from pyspark.sql import functions as F

from riskfeed import constants as C
from riskfeed import sinks
from riskfeed.operators import backfill as BF
from riskfeed.operators import digest as DG
from riskfeed.operators.common import clear_memo
from riskfeed.plans import daily
from riskfeed.sources import lists
from riskfeed.sources.feed import Feed, count_files, read_feed, read_pages, unreadable_files
from riskfeed.sources.lexicon import default_lexicon, read_lexicon


@dataclass
class DailyInputs:
    terms_csv: str
    feed_root: str
    pages: str
    store_root: str
    archive: str
    block_csv: str = ""
    allow_csv: str = ""
    risk_set: str = "enterprise"
    lexicon: str | None = None
    resolved: str = ""
    quarantine: str = ""


MAX_CONFLICTS = 20


def _until_published(job):
    """Run ``job`` again from what is live now as long as another writer was faster."""
    for _ in range(MAX_CONFLICTS):
        try:
            return job()
        except sinks.StoreConflict:
            clear_memo()
    return job()


def daily_job(spark: SparkSession, inp: DailyInputs, p: daily.DailyParams, export_csv: str | None = None,
              append_only: bool = True) -> dict:
    """PIPE1 over files; returns the run audit. A versioned store that another writer has changed
    meanwhile makes the run start again from the new version. Landed feed files that cannot be read are counted
    in it and, where ``inp.quarantine`` names a folder, listed there.

    Default: only the new rows are written (appended to their date partitions); readers take
    the window with :func:`sinks.read_window`. ``append_only=False``: the in-window rows become
    a new store version and aged rows go to the archive first (the reproduced behaviour)."""
    if not append_only:
        return _until_published(lambda: _daily_job(spark, inp, p, export_csv, False))
    return _daily_job(spark, inp, p, export_csv, True)


def _daily_job(spark: SparkSession, inp: DailyInputs, p: daily.DailyParams, export_csv: str | None,
               append_only: bool) -> dict:
    clear_memo()
    dictionary = lists.decode_dictionary(lists.read_terms(spark, inp.terms_csv, inp.risk_set))
    block = lists.read_source_list(spark, inp.block_csv) if inp.block_csv else lists.normalize_list(
        spark.createDataFrame([], "name string"))
    allow = lists.read_source_list(spark, inp.allow_csv) if inp.allow_csv else lists.normalize_list(
        spark.createDataFrame([], "name string"))
    lex = _lexicon(spark, inp.lexicon)
    # append-only: the live store is the window of the appended rows (older
    # partitions are the archive and are pruned away)
    live = sinks.snapshot(spark, inp.store_root) if not append_only else None
    stored = (sinks.read_window(spark, inp.store_root, p.as_of, p.window_days, updates=False)[0] if append_only
              else sinks.read_version(spark, live))
    obs, landed, store_audit = Observation("daily_run"), Observation("landed_feed"), daily.StoreAudit()
    resolved = spark.read.parquet(inp.resolved) if inp.resolved else None
    feed = Feed(spark, inp.feed_root)  # parsed once, for the items and for the files that cannot be read
    new = daily.new_rows(read_feed(spark, feed, resolved, landed), dictionary, read_pages(spark, inp.pages),
                         block, allow, lex, stored, p, obs, store_audit)
    new = daily.materialize(new)   # once: the store and the archive read it
    # every count below is observed while the rows are read or written for the run itself
    nothing = {"new_rows": 0, "new_null_dates": 0, "new_mean_score": None, "new_current_rows": 0}
    audit = (daily.observed(obs, lambda: nothing) | store_audit.get
             | daily.observed(landed, lambda: count_files(feed)))
    audit["combined_rows"] = audit["stored_rows"] + audit["new_rows"]
    in_window = audit.pop("new_current_rows")
    if audit["unreadable_files"] and inp.quarantine:
        sinks.write_quarantine(unreadable_files(feed), inp.quarantine, p.as_of)
    if append_only:
        sinks.append_new(new, inp.store_root)
        audit["current_rows"] = audit["stored_rows"] + in_window  # what was read of the store is its window
    else:
        current, old = daily.with_store(stored, new, p)
        archived, kept = Observation("archived"), Observation("current")
        audit["archived_rows"] = 0
        if not old.isEmpty():  # before the publish: until then the aged rows are in the live version
            sinks.write_archive(old.observe(archived, F.count(F.lit(1)).alias("n")), inp.archive, p.as_of)
            audit["archived_rows"] = daily.observed(archived, lambda: {"n": 0})["n"]
        audit["store_version"] = sinks.write_current(
            current.observe(kept, F.count(F.lit(1)).alias("n")), inp.store_root, live.number)
        audit["current_rows"] = daily.observed(kept, lambda: {"n": 0})["n"]
    if export_csv:
        cur = (sinks.read_window(spark, inp.store_root, p.as_of, p.window_days)[0] if append_only
               else sinks.read_current(spark, inp.store_root))
        if cur is not None:
            sinks.export_csv(cur, export_csv, inp.risk_set)
    return audit


def backfill_job(spark: SparkSession, store_root: str, pages: str, as_of: str,
                 start: str = C.BACKFILL_RANGE[0], end: str = C.BACKFILL_RANGE[1],
                 lexicon: str | None = None, append_only: bool = True) -> str | None:
    """PIPE2: fill missing text of the latest 3-day batch; publish only when a
    row changed. Versioned store: returns the new version or None, and starts again if another
    writer was faster. Append-only store: only the batch's date partitions are read, the changed
    rows are appended as updates; returns "dates:<first>..<last>" or None."""
    if not append_only:
        return _until_published(lambda: _backfill_version(spark, store_root, pages, as_of, start, end, lexicon))
    clear_memo()
    store = sinks.read_appended(spark, store_root)
    if store is None:
        return None
    latest = BF.candidates(store, start, end).select(F.max("published_date")).first()[0]
    if latest is None:
        return None
    first = BF.batch_first_day(latest)
    touched = store.where(F.col("published_date").between(F.lit(first), F.lit(latest)))  # pruned
    targets = BF.batch_targets(touched, start, end)
    merged = BF.merge(touched, targets, read_pages(spark, pages), _lexicon(spark, lexicon), as_of)
    changed = daily.materialize(merged.where(F.col("backfilled")))
    if changed.isEmpty():
        return None
    sinks.append_updates(changed, store_root)
    return f"dates:{first}..{latest}"


def _backfill_version(spark: SparkSession, store_root: str, pages: str, as_of: str, start: str, end: str,
                      lexicon: str | None) -> str | None:
    clear_memo()
    live = sinks.snapshot(spark, store_root)
    store = sinks.read_version(spark, live)
    if store is None:
        return None
    targets = BF.batch_targets(store, start, end)
    merged = BF.merge(store, targets, read_pages(spark, pages), _lexicon(spark, lexicon), as_of)
    return sinks.publish_backfill(daily.materialize(merged), store_root, live.number)


def _lexicon(spark: SparkSession, path: str | None):
    return read_lexicon(spark, path) if path else default_lexicon(spark)


def digest_job(spark: SparkSession, store_root: str, out_root: str, as_of: str,
               append_only: bool = True) -> int:
    """PIPE3: per-risk digest and prompt rows of the last 4 weeks of either kind of store."""
    clear_memo()
    store = sinks.read_appended(spark, store_root) if append_only else sinks.read_current(spark, store_root)
    if store is None:
        return 0
    dig = DG.risk_prompt(DG.risk_digest(DG.last_four_weeks(store, as_of)))
    dig = daily.materialize(dig)
    sinks.write_narratives(dig, out_root, as_of)
    return dig.count()


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="riskfeed.plans.jobs")
    sub = ap.add_subparsers(dest="job", required=True)
    d = sub.add_parser("daily")
    for a in ("terms-csv", "feed-root", "pages", "store-root", "archive"):
        d.add_argument(f"--{a}", required=True)
    for a in ("block-csv", "allow-csv", "lexicon", "export-csv", "resolved", "quarantine"):
        d.add_argument(f"--{a}", default=None)
    d.add_argument("--risk-set", default="enterprise", choices=["enterprise", "emerging"])
    d.add_argument("--as-of", required=True)
    d.add_argument("--max-terms", type=int, default=None, help=f"the reproduced jobs take {C.MAX_TERMS}")
    d.add_argument("--max-items-per-term", type=int, default=None,
                   help=f"the reproduced jobs take {C.MAX_ITEMS_PER_TERM}")
    d.add_argument("--score-domain-from", default="source_url", choices=["source_url", "link", "source_site"])
    d.add_argument("--window-days", type=int, default=C.WINDOW_DAYS)
    b = sub.add_parser("backfill")
    for a in ("store-root", "pages", "as-of"):
        b.add_argument(f"--{a}", required=True)
    b.add_argument("--start", default=C.BACKFILL_RANGE[0])
    b.add_argument("--end", default=C.BACKFILL_RANGE[1])
    b.add_argument("--lexicon", default=None)
    g = sub.add_parser("digest")
    for a in ("store-root", "out-root", "as-of"):
        g.add_argument(f"--{a}", required=True)
    for job in (d, b, g):
        job.add_argument("--versioned", action="store_true",
                         help="the store is rewritten as a new version each run instead of appended to")
    args = ap.parse_args(argv)
    spark = SparkSession.builder.appName(f"riskfeed-{args.job}").getOrCreate()
    if args.job == "daily":
        inp = DailyInputs(args.terms_csv, args.feed_root, args.pages, args.store_root, args.archive,
                          args.block_csv or "", args.allow_csv or "", args.risk_set, args.lexicon, args.resolved or "",
                          args.quarantine or "")
        p = daily.DailyParams(as_of=args.as_of, max_terms=args.max_terms,
                              max_items_per_term=args.max_items_per_term, window_days=args.window_days,
                              score_domain_from=args.score_domain_from)
        print(daily_job(spark, inp, p, args.export_csv, append_only=not args.versioned))
    elif args.job == "backfill":
        print(backfill_job(spark, args.store_root, args.pages, args.as_of, args.start, args.end, args.lexicon,
                           append_only=not args.versioned))
    else:
        print(digest_job(spark, args.store_root, args.out_root, args.as_of, append_only=not args.versioned))


if __name__ == "__main__":
    main()
