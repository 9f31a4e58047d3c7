"""Write the physical plans of selected registered queries to PLANS.md.

    python scripts/explain_plans.py [sf_dir]
"""
import contextlib
import io
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from regloom.plans import registry  # noqa: E402
from regloom.session import ensure_checkpoint_dir, local_session  # noqa: E402

PICK = ["c16_used_car_clean", "p1_holdout_split", "e6_correlation_matrix",
        "g1_gram_aggregate", "n3_encode_onehot_label"]


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8, 8)
    ensure_checkpoint_dir(spark)
    out = ["# Physical plans of selected queries", "",
           f"Generated by `scripts/explain_plans.py` at `{sf}` (local[8], AQE on; plans before",
           "AQE re-optimisation). Eager statistics a query needs (levels, boundaries,",
           "checkpoints) have already run when the plan is printed.", ""]
    from regloom.operators.metrics import regression_metrics
    from regloom.plans.q_models import order_features
    extra = {
        "metrics over the prediction table (M10, before the run table is written)":
            lambda: regression_metrics(registry.prediction_table(spark, sf), by=["model", "run"]),
        "per-order feature table (lineitem aggregate, joins, one-hot, min-max)":
            lambda: order_features(spark, sf)[0],
    }
    items = list(extra.items()) + [(n, (lambda n=n: registry.QUERIES[n](spark, sf))) for n in PICK]
    for name, make in items:
        df = make()
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain("formatted")
        out += [f"## {name}", "", "```", buf.getvalue().strip(), "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(out))


if __name__ == "__main__":
    main()
