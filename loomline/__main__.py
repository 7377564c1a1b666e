"""Runs a query and writes its result: python -m loomline QUERY DATA OUT [--format csv]."""

from __future__ import annotations

import argparse
import importlib.util

from loomline.session import ROOT, session


def main() -> None:
    parser = argparse.ArgumentParser(prog="loomline", description=__doc__)
    parser.add_argument("query", help="name of a query, or 'list'")
    parser.add_argument("data", nargs="?", help="folder of the tables")
    parser.add_argument("out", nargs="?", help="folder to write")
    parser.add_argument("--format", choices=("parquet", "json", "csv"), default="parquet")
    given = parser.parse_args()
    spec = importlib.util.spec_from_file_location("__spark_entry__", ROOT / "__spark_entry__.py")
    entry = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(entry)
    queries = entry.queries()
    if given.query == "list":
        print("\n".join(sorted(queries)))
        return
    if given.query not in queries or not given.data or not given.out:
        parser.error("name a query of the list, the folder of the tables and the folder to write")
    queries[given.query](session(), given.data).write.mode("overwrite").format(given.format).save(given.out)


if __name__ == "__main__":
    main()
