"""Print the physical plans (``explain("formatted")``) of the headline batch queries.

usage: python scripts/show_plans.py [sf_dir] > PLANS.md
Streaming keys are skipped: building them runs the stream.
"""

import contextlib
import io
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sensorweave.plans import catalog  # noqa: E402
from sensorweave.session import get_session  # noqa: E402


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session("local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    print("# Physical plans of the headline queries\n")
    print(f"Generated by `scripts/show_plans.py {sf_dir}` (AQE plans before execution; AQE may")
    print("still turn a shuffle join into a broadcast once it has measured a side).\n")
    for key in catalog.HEADLINE:
        if key.startswith("stream_"):
            continue
        df = catalog.QUERIES[key](spark, sf_dir)
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain("formatted")
        print(f"## {key}\n\n```")
        print(buf.getvalue().strip().replace(sf_dir, "<sf_dir>"))
        print("```\n")


if __name__ == "__main__":
    main()
