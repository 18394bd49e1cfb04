"""Command line: one full diff run.

    python -m stocktake --map s3-uris-to-analyze.csv --config analysis-config.json \\
        --inventory <report of raw entries> [--inventory-format parquet|orc|csv] \\
        [--columns key=Key,size=Size,...] [--csv-columns Bucket,Key,...] [--account pro] [--url-encoded-keys] \\
        --out <shared folder> [--format csv] [--run-id 20250101120000]

Instead of ``--inventory``: ``--listing <listing table written by an earlier run>`` with
``--listing-run <id>`` (default: its newest run), ``--account-csvs <folder with one <account>.csv per
account>`` or ``--scan <store>`` (``s3://`` or any root that holds ``<bucket>/<key>``, ``{account}`` in it stands for the
account; the mapped folders are listed, ``--hash`` reads the objects found for their MD5). Outputs go to
``<out>/accounts``, ``<out>/all_accounts`` and ``<out>/analysis``, partitioned by run id, with
the reports ``unmapped_objects``, ``subfolders``, ``duplicate_keys`` and ``unlike_hashes`` beside them (their row counts are printed); ``--format
csv`` adds CSV exports under ``<out>/csv``.
"""

from __future__ import annotations

import argparse
import sys

from stocktake.operators import uri_map as M
from stocktake.plans import pipeline as P
from stocktake.session import build_session, cluster_session
from stocktake.sinks import tables as S
from stocktake.sources import readers as RD
from stocktake.sources.objects import list_folders, with_content_hash


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="stocktake")
    ap.add_argument("--map", required=True)
    ap.add_argument("--config", required=True)
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--inventory")
    src.add_argument("--listing")
    src.add_argument("--scan", help="store that holds <bucket>/<key>, e.g. s3://")
    src.add_argument("--account-csvs", help="folder with one <account>.csv listing per account")
    ap.add_argument("--inventory-format", default="parquet", choices=["parquet", "orc", "csv"])
    ap.add_argument("--columns", default="", help="report's column names: field=name,...")
    ap.add_argument("--csv-columns", default="", help="column names of a CSV report without a header line")
    ap.add_argument("--on-unreadable", default="fail", choices=["fail", "null"], help="sizes and dates of the report that can't be read")
    ap.add_argument("--account", help="account of an inventory without an account column")
    ap.add_argument("--url-encoded-keys", action="store_true")
    ap.add_argument("--listing-run", help="run of --listing to diff (default: the newest)")
    ap.add_argument("--one-line-rows", action="store_true", help="CSV input without line breaks in cells: its files are split among tasks")
    ap.add_argument("--hash", action="store_true", help="with --scan: MD5 of every object found")
    ap.add_argument("--part-bytes", type=int, help="with --hash: digests of uploads in parts of this size")
    ap.add_argument("--on-unlike-hashes", default="report", choices=["report", "fail"])
    ap.add_argument("--out", required=True)
    ap.add_argument("--format", default="parquet", choices=["parquet", "csv"])
    ap.add_argument("--run-id")
    ap.add_argument("--on-subfolders", default="report", choices=["report", "fail"])
    ap.add_argument("--ordered", action="store_true", help="write the analysis in map order (a global sort)")
    ap.add_argument("--master")
    args = ap.parse_args(argv)

    # Under spark-submit the launcher's master is kept; --master is for local runs.
    spark = build_session(master=args.master) if args.master else cluster_session()
    wide = RD.read_uri_map(spark, args.map)
    config = RD.read_rule_config(spark, args.config)
    raw = listing = None
    if args.inventory:
        raw = RD.read_inventory(
            spark,
            args.inventory,
            args.inventory_format,
            account=args.account,
            columns=dict(x.split("=", 1) for x in args.columns.split(",") if x),
            csv_columns=[x for x in args.csv_columns.split(",") if x] or None,
            url_encoded_keys=args.url_encoded_keys,
            on_unreadable=args.on_unreadable,
            multi_line=not args.one_line_rows,
        )
    elif args.listing:
        listing = RD.read_listing_table(spark, args.listing, args.listing_run or RD.newest_run(spark, args.listing))
    elif args.account_csvs:
        listing = RD.read_account_csvs(spark, args.account_csvs, M.accounts_of(wide), not args.one_line_rows)
    else:
        raw = list_folders(P.prepare_map(wide), store=args.scan)
        if args.hash:
            raw = with_content_hash(raw, args.scan, args.part_bytes)
    run_id = args.run_id or S.new_run_id()
    done = P.full_diff(
        wide,
        config,
        raw=raw,
        listing=listing,
        on_subfolders=args.on_subfolders,
        on_unlike_hashes=args.on_unlike_hashes,
        out_root=args.out,
        run_id=run_id,
        fmt=args.format,
        ordered=args.ordered,
    )
    print(f"run {run_id} written to {args.out}")
    print(f"rows listed: {done.counts['n_rows']}, re-keyed: {done.counts['n_rekeyed']}")
    for name, report in (("rows outside the map", done.unmapped), ("keys listed more than once", done.duplicates), ("sub-folders", done.subfolders), ("kinds of hashes that never match", done.unlike_hashes)):
        if report is not None:
            print(f"{name}: {report.count()}")
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
