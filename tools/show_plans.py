"""Print the physical-plan tree (the outline of ``explain("formatted")``)
of registered queries, as markdown.

usage: python tools/show_plans.py SF_DIR key [key ...] > PLANS.md
"""

from __future__ import annotations

import contextlib
import io
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from trawl.plans.catalog import QUERIES  # noqa: E402
from trawl.session import build_session  # noqa: E402


def outline(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    tree = text.split("\n\n\n")[0]
    return tree.replace("== Physical Plan ==\n", "")


def main() -> None:
    sf, keys = sys.argv[1], sys.argv[2:]
    spark = build_session()
    for key in keys:
        df = QUERIES[key](spark, sf)
        print(f"### `{key}`\n\n```\n{outline(df).rstrip()}\n```\n")
    spark.stop()


if __name__ == "__main__":
    main()
