"""Command line: write every extract of one study.

    python -m stayflow --parquet-dir s3://bucket/clinical --out s3://bucket/extracts \\
        --config study.json [--format csv|parquet]

or with catalog tables: ``--database clarity``; ``--work-dir`` names a shared folder for
intermediates where spark.checkpoint.dir is not set. ``study.json`` holds the StudyConfig
fields (start, end, units, vital_ids, intervention_ids, ...); see README.md.
"""

from __future__ import annotations

import argparse
import json

from stayflow.plans.run import write_all
from stayflow.session import get_session
from stayflow.sources.catalog import SourceCatalog
from stayflow.sources.config import config_from_dict


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="stayflow", description=__doc__.splitlines()[0])
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--parquet-dir")
    src.add_argument("--database")
    ap.add_argument("--out", required=True)
    ap.add_argument("--config", required=True, help="JSON file with StudyConfig fields")
    ap.add_argument("--work-dir", help="folder that all executors share, for intermediates "
                    "(default: spark.checkpoint.dir)")
    ap.add_argument("--format", default="csv", choices=["csv", "parquet"])
    ap.add_argument("--category-collation", default=None,
                    help="e.g. UTF8_LCASE_RTRIM for case-insensitive category names")
    args = ap.parse_args(argv)
    with open(args.config) as fh:
        cfg = config_from_dict(json.load(fh))
    spark = get_session()
    if args.work_dir:
        spark.sparkContext.setCheckpointDir(args.work_dir)
    catalog = SourceCatalog(spark, parquet_dir=args.parquet_dir, database=args.database,
                            category_collation=args.category_collation)
    for name, path in write_all(catalog, args.out, cfg, fmt=args.format).items():
        print(f"{name}\t{path}")


if __name__ == "__main__":
    main()
