"""Write PLANS.md: final (after AQE) physical plans of the key queries at sf0.01.

    PYTHONPATH=. python tests/plan_report.py
"""

import re
import sys

sys.path.insert(0, ".")

from tablewise.plans.queries import QUERIES  # noqa: E402
from tablewise.session import get_spark  # noqa: E402

KEY = {
    "profile_lineitem": "one codegen'd partial + final aggregate, one scan, one tiny exchange",
    "profile_by_label": "slice ranges pushed into the scan; grouped partial + final aggregate",
    "slice_three_days": "OR of three half-open ranges in PushedFilters; no shuffle",
    "corrupt_mixed": "hash expressions only: a single narrow codegen'd stage",
    "category_topk": "unpivot -> map-side combined count -> group limit -> rank",
    "stratified_split": "written class table broadcast (size checked); one narrow final pass",
    "feature_table_all_values": "label rates joined per column from written parts",
    "bounded_sample": "TakeOrderedAndProject (top-k, memory bounded by k)",
    "roc_auc": "counts per distinct score written once; running sums per range",
}


def final_plan(df) -> str:
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    text = text.split("+- == Initial Plan ==")[0]
    text = re.sub(r"#\d+L?", "", text)
    text = re.sub(r"\[plan_id=\d+\]", "", text)
    lines = []
    for line in text.splitlines():
        if "FileScan" in line:
            head = line.split(" Batched:")[0]
            pushed = re.search(r"PushedFilters: (\[.*?\])(, ReadSchema|$)", line)
            schema = re.search(r"ReadSchema: (\S+)", line)
            lines.append(head[:160])
            indent = " " * (len(head) - len(head.lstrip()) + 6)
            if pushed:
                lines.append(f"{indent}PushedFilters: {pushed.group(1)[:300]}")
            if schema:
                lines.append(f"{indent}ReadSchema: {schema.group(1)[:200]}")
        else:
            lines.append(line[:160])
    return "\n".join(lines)


def main():
    spark = get_spark("local[8]", 8, extra={"spark.ui.showConsoleProgress": "false",
                                            "spark.sql.maxMetadataStringLength": "100000"})
    out = ["# Physical plans of key queries (sf0.01, local[8], after AQE)", "",
           "Generated by `tests/plan_report.py`. `*(n)` marks whole-stage codegen.", ""]
    for name, why in KEY.items():
        out += [f"## {name}", "", why, "", "```", final_plan(QUERIES[name](spark, "/root/testdata/sf0.01")),
                "```", ""]
    with open("PLANS.md", "w") as f:
        f.write("\n".join(out))


if __name__ == "__main__":
    main()
