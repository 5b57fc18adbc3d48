"""Print the dashboard payload (five result sets + key figures) as JSON.

usage: python scripts/dashboard.py [sf_dir]

The results are collected only here, at the output edge; each is bounded by
its grouping vocabulary or LIMIT.  Values are text, as the dashboard expects.
"""
import json
import sys

sys.path.insert(0, __file__.rsplit("/scripts/", 1)[0])

from carelake.operators import dashboard as D  # noqa: E402
from carelake.plans.session import build_session  # noqa: E402
from carelake.sources.domain import Domain  # noqa: E402


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[*]", "carelake-dashboard")
    d = Domain.of(spark, sf)
    pack = D.summary_pack({
        "appeals_by_status": lambda: D.appeals_by_status(d.appeals),
        "claims_by_status": lambda: D.claims_by_status(d.claims),
        "top_denial_reasons": lambda: D.top_denial_reasons(d.appeals),
        "recent_appeals": lambda: D.recent_appeals(d.appeals),
        "member_count": lambda: D.member_count(d.members),
    })
    out: dict = {}
    for r in pack.orderBy("query", "row_no").collect():
        out.setdefault(r.query, [])
        if r.record is not None:
            out[r.query].append(json.loads(r.record))
        else:
            out.setdefault("errors", {})[r.query] = r.error
    kpi = D.kpi_cards(d.appeals, d.claims, d.members).collect()[0].asDict()
    out["kpi_cards"] = {k: str(v) for k, v in kpi.items()}
    print(json.dumps(out, indent=1))
    spark.stop()


if __name__ == "__main__":
    main()
