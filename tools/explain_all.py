"""Summarise the final (post-AQE) physical plan of every registered query
over stored tables in docs/PLANS.md; with a second argument, write the plans
themselves to that file.

    python tools/explain_all.py [sf_dir [plans_file]]
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys
import tempfile
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from subsight.lake import Lake  # noqa: E402
from subsight.plans import pipeline  # noqa: E402
from subsight.plans.registry import QUERIES  # noqa: E402
from subsight.plans.session import local_session  # noqa: E402
from subsight.sources.catalog import LakeConfig
from subsight.sources.testdata import raw_tables  # noqa: E402


def _summary_row(name: str, text: str) -> str:
    """Counts over the final (post-AQE) plan of one formatted explain."""
    tree = text.split("\n\n")[0]
    if "== Final Plan ==" in tree:
        tree = tree.split("== Final Plan ==")[1].split("== Initial Plan ==")[0]
    nodes = []
    for line in tree.splitlines():
        m = re.match(r"^[\s:+\-*]*([A-Za-z]\w*)(?:\(skew=true\))?.*\((\d+)\)\s*$", line)
        if m:
            nodes.append((m.group(1), m.group(2)))
    blocks = {m.group(1): m.group(0) for m in re.finditer(r"(?ms)^\((\d+)\) .*?(?=^\(\d+\) |\Z)", text)}
    kinds = {"hash": 0, "range": 0, "single": 0, "BroadcastHashJoin": 0, "SortMergeJoin": 0,
             "HashAggregate": 0, "SortAggregate": 0}
    pushed = False
    for node, nid in nodes:
        block = blocks.get(nid, "")
        if node == "Exchange":
            if "hashpartitioning" in block:
                kinds["hash"] += 1
            elif "rangepartitioning" in block:
                kinds["range"] += 1
            elif "SinglePartition" in block:
                kinds["single"] += 1
        elif node in kinds:
            kinds[node] += 1
        elif node.startswith("Scan"):
            m = re.search(r"PushedFilters: \[(.*)\]", block)
            if m and any(not f.startswith("IsNotNull") for f in re.split(r", (?=[A-Z])", m.group(1)) if f):
                pushed = True
    subqueries = len(set(re.findall(r"Subquery:(\d+)", text)))
    return (f"| `{name}` | {kinds['hash']} | {kinds['range']} | {kinds['single']} | "
            f"{kinds['BroadcastHashJoin']} | {kinds['SortMergeJoin']} | {kinds['HashAggregate']} | "
            f"{kinds['SortAggregate']} | {subqueries} | {'yes' if pushed else ''} |")


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    scratch = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark = local_session(8, warehouse=os.path.join(scratch, "warehouse"))
    config = LakeConfig(schema="plans")
    raw = Lake.from_testdata(spark, sf_dir)
    per_file = max(1, raw["bronze_reading_logs"].count() // 8)
    pipeline.ingest_bronze(spark, config, raw, per_file)
    pipeline.ingest_billing(spark, config, raw, per_file)
    pipeline.run_pipeline(spark, config)
    stored = Lake.from_catalog(spark, config, extra=raw_tables(spark, sf_dir))
    out = ["# Physical plans over stored tables",
           "",
           f"Final adaptive plans (after execution) of every registered query, over tables written by the "
           f"pipeline from `{sf_dir}`. The plans themselves: `python tools/explain_all.py {sf_dir} FILE`.",
           "",
           "Per query: shuffle exchanges (hash / range / single-partition for global aggregates), "
           "joins by strategy, aggregates by kind, scalar subqueries, and whether a filter reached a scan.",
           "",
           "| Query | hash | range | single | BHJ | SMJ | HashAgg | SortAgg | subq | pushed filter |",
           "|---|---|---|---|---|---|---|---|---|---|"]
    sections = []
    for name, build in QUERIES.items():
        df = build(stored)
        df.collect()
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain(mode="formatted")
        text = buf.getvalue()
        text = re.sub(r"file:/tmp/run-[^\]/]*/warehouse/", "warehouse/", text)
        text = re.sub(r"#\d+L?", "", text)
        out.append(_summary_row(name, text))
        sections += [f"## {name}", "", "```", text.strip(), "```", ""]
    (ROOT / "docs" / "PLANS.md").write_text("\n".join(out) + "\n")
    if len(argv) > 2:
        Path(argv[2]).write_text("\n".join(sections))
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
