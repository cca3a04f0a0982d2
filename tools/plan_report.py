"""Physical-plan review of every registered query: writes PLANS.md.

    python tools/plan_report.py [/root/testdata/sf0.1] [mode]

Plans are taken with the shared inputs unmaterialised (``mode=none``), so each plan shows the full
path from the Parquet scans, as a cluster run with ``table`` materialisation would for the inputs.
Counts come from ``explain("formatted")`` (the initial adaptive plan; AQE may still turn a sort-merge
join into a broadcast join at runtime, never the other way round for a table over the threshold).
"""

from __future__ import annotations

import contextlib
import io
import re
import sys

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

from ledgerline.plans.registry import QUERIES, Inputs, build  # noqa: E402
from ledgerline.session import build_session  # noqa: E402

COUNTED = {
    "shuffles": r"^\s*[:+\- ]*Exchange \(\d+\)",
    "broadcasts": r"BroadcastExchange \(\d+\)",
    "bhj": r"BroadcastHashJoin",
    "smj": r"SortMergeJoin",
    "window": r"\bWindow \(\d+\)",
    "wgl": r"WindowGroupLimit",
    "generate": r"Generate \(\d+\)",
    "cartesian": r"CartesianProduct|BroadcastNestedLoopJoin",
}


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def summarize(txt: str) -> dict:
    tree = txt.split("\n\n")[0]
    out = {k: len(re.findall(p, tree, flags=re.M)) for k, p in COUNTED.items()}
    out["single_partition"] = len(re.findall(r"Arguments: SinglePartition", txt))
    out["subqueries"] = len(re.findall(r"Subquery:\d+", txt))
    schemas = sorted(set(re.findall(r"ReadSchema: (struct<[^>]*>)", txt)))
    out["widest_read"] = max((s.count(":") for s in schemas), default=0)
    out["pushed"] = sum(1 for line in txt.splitlines() if "PushedFilters: [" in line and "PushedFilters: []" not in line)
    out["scans"] = len(re.findall(r"Scan parquet", tree))
    return out


def main(argv) -> None:
    sf = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    mode = argv[2] if len(argv) > 2 else "none"
    spark = build_session("local[8]", shuffle_partitions=8)

    def all_plans() -> list[tuple[str, dict]]:
        return [(key, summarize(plan_text(build(key, spark, sf, Inputs(spark, sf, mode=mode))))) for key in QUERIES]

    rows = all_plans()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    large = all_plans()
    cols = ["scans", "pushed", "widest_read", "shuffles", "broadcasts", "bhj", "smj", "window", "wgl", "generate",
            "subqueries", "single_partition", "cartesian"]
    lines = [
        "# PLANS",
        "",
        f"Physical-plan review of every registered query (`tools/plan_report.py`, {sf}, inputs `{mode}`).",
        "",
        "Columns: parquet scans; scans with pushed filters; widest ReadSchema (columns read); shuffle",
        "exchanges; broadcast exchanges; broadcast-hash and sort-merge joins; windows; window group limits",
        "(top-rank filters applied before the shuffle); generators (explode); scalar/exists subqueries;",
        "single-partition exchanges; cartesian or nested-loop joins.",
        "",
        "| query | " + " | ".join(cols) + " |",
        "| --- | " + " | ".join("---" for _ in cols) + " |",
    ]
    for key, s in rows:
        lines.append(f"| {key} | " + " | ".join(str(s[c]) for c in cols) + " |")
    tot = {c: sum(s[c] for _, s in rows) for c in ("cartesian", "single_partition", "smj")}
    lines += ["", f"Totals: cartesian/nested-loop joins {tot['cartesian']}, single-partition exchanges "
              f"{tot['single_partition']}, sort-merge joins {tot['smj']}.", ""]
    short = ["scans", "shuffles", "smj", "window", "wgl", "single_partition", "cartesian"]
    lines += [
        "## Without broadcast joins",
        "",
        "The same with `spark.sql.autoBroadcastJoinThreshold=-1`: what remains when every table is past the threshold.",
        "",
        "| query | " + " | ".join(short) + " |",
        "| --- | " + " | ".join("---" for _ in short) + " |",
        *(f"| {key} | " + " | ".join(str(s[c]) for c in short) + " |" for key, s in large),
        "",
    ]
    open(__file__.rsplit("/tools/", 1)[0] + "/PLANS.md", "w").write("\n".join(lines))
    print("\n".join(lines))


if __name__ == "__main__":
    main(sys.argv)
