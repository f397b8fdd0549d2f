"""Summarise the physical plan of every registered query into PLANS.md:
shuffles by kind, joins, scans with pushed filters and columns read.

usage: python scripts/plan_report.py [sf_dir]
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from terracat.queries import QUERIES  # noqa: E402
from terracat.session import get_session  # noqa: E402


def formatted(df) -> str:
    """``explain("formatted")`` text, captured from stdout."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def summarise(text: str) -> dict:
    body = text.split("\n\n", 1)[1] if "\n\n" in text else text
    ex = re.findall(r"Arguments: (hashpartitioning|rangepartitioning|SinglePartition|RoundRobinPartitioning)", body)
    joins = re.findall(r"^\(\d+\) (\w+Join)\s*\n.*?Join type: (\w+)", body, re.M | re.S)
    scans = []
    for m in re.finditer(r"\(\d+\) Scan (\w+) ?(\S*)\s*\n(.*?)(?=\n\(\d+\) |\Z)", body, re.S):
        block = m.group(3)
        loc = re.search(r"Location: \w+ \[([^\]]+)\]", block)
        table = os.path.basename(loc.group(1).split(",")[0]).replace(".parquet", "") if loc else m.group(1)
        table = re.sub(r"-[0-9a-f]{12}$", " (scratch)", table)
        rs = re.search(r"ReadSchema: struct<(.*)>", block)
        cols = len([c for c in re.split(r",(?![^<]*>)", rs.group(1)) if c]) if rs and rs.group(1) else 0
        pf = re.search(r"PushedFilters: \[(.*)\]", block)
        part = re.search(r"PartitionFilters: \[(.*)\]", block)
        scans.append((table, cols, pf.group(1) if pf else "", part.group(1) if part else ""))
    return {
        "shuffles": {k: ex.count(k) for k in sorted(set(ex))},
        "broadcasts": body.count("BroadcastExchange") // 2 if body.count("BroadcastExchange") else 0,
        "joins": [f"{j}:{t}" for j, t in joins],
        "scans": scans,
        "python": any(n in body for n in ("BatchEvalPython", "ArrowEvalPython", "InPandas")),
    }


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_session("local[8]", shuffle_partitions=16)
    out = ["# Physical plans", "",
           f"Generated by `scripts/plan_report.py` from `explain(\"formatted\")` on {os.path.basename(sf_dir)} "
           "(initial plans; AQE may still turn a shuffled join into a broadcast at run time). "
           "Jobs that number rows read their tagged rows from the Parquet files `dense_id` writes to the "
           "checkpoint folder (scans named `dense_id (scratch)`); the scans below a numbering appear in "
           "the plan of that write, not here.", ""]
    for name, (fn, _) in QUERIES.items():
        s = summarise(formatted(fn(spark, sf_dir)))
        out.append(f"## {name}")
        out.append(f"- shuffles: {s['shuffles'] or 'none'}; broadcast exchanges: {s['broadcasts']}; "
                   f"python in plan: {s['python']}")
        if s["joins"]:
            out.append(f"- joins: {', '.join(s['joins'])}")
        for table, cols, pf, part in s["scans"]:
            line = f"- scan `{table}`: {cols} column(s) read"
            if pf:
                line += f"; pushed: `{pf}`"
            if part:
                line += f"; partition filters: `{part[:160]}`"
            out.append(line)
        out.append("")
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as fh:
        fh.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
