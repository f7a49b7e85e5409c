"""Command line: ``python -m civica <command>`` (or ``spark-submit``).

    load     --raw DIR --database DB [--out DIR] [--prefix 13]
    model    --database DB [--predictions PATH] [--max-iter 300] [--quarter-mode mean|fanout]
    shares   --database DB [--years 2017 2022] [--percent]
    history
    crime    --database DB [--years 2017 2022]
    query    NAME --tables DIR [--show N]
    explain  NAME --tables DIR            (formatted physical plan)
"""

from __future__ import annotations

import argparse
import sys


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="civica")
    sub = ap.add_subparsers(dest="cmd", required=True)
    p = sub.add_parser("load", help="land and harmonise the raw files into warehouse tables")
    p.add_argument("--raw", required=True)
    p.add_argument("--database", required=True)
    p.add_argument("--out")
    p.add_argument("--prefix", default="13")
    p = sub.add_parser("model", help="features, vote model, evaluation and projection")
    p.add_argument("--database", required=True)
    p.add_argument("--predictions")
    p.add_argument("--max-iter", type=int, default=300)
    p.add_argument("--quarter-mode", default="mean", choices=["mean", "fanout"])
    for name in ("shares", "crime"):
        p = sub.add_parser(name)
        p.add_argument("--database", required=True)
        p.add_argument("--years", type=int, nargs="+", default=[2017, 2022])
        if name == "shares":
            p.add_argument("--percent", action="store_true", help="from the percentage column of the other layouts")
    sub.add_parser("history", help="literal vote-count history and projection")
    p = sub.add_parser("query", help="run one catalogue query")
    p.add_argument("name")
    p.add_argument("--tables", required=True)
    p.add_argument("--show", type=int, default=20)
    p = sub.add_parser("explain", help="print the formatted plan of a catalogue query")
    p.add_argument("name")
    p.add_argument("--tables", required=True)
    a = ap.parse_args(argv)

    from civica.plans import elections as J
    from civica.session import get_spark
    spark = get_spark()
    if a.cmd == "load":
        written = J.load_lake(spark, J.LakeConfig(raw_dir=a.raw, database=a.database, out_dir=a.out,
                                                  department_prefix=a.prefix))
        for k, v in written.items():
            print(k, "->", v)
    elif a.cmd == "model":
        out = J.model_job(spark, J.ModelConfig(database=a.database, predictions_path=a.predictions,
                                               max_iter=a.max_iter, quarter_mode=a.quarter_mode))
        out["r2"].show()
        out["class_metrics"].show()
        out["national"].show()
    elif a.cmd == "shares":
        out = J.party_share_analysis(spark, a.database, a.years, percent=a.percent)
        out["shares"].orderBy("annee", "parti").show(100)
        out["ranking"].orderBy("annee", "rang").show(100)
    elif a.cmd == "history":
        J.literal_vote_history(spark)["ranking"].orderBy("annee", "rang").show(100)
    elif a.cmd == "crime":
        out = J.right_vote_and_crime(spark, a.database, a.years)
        out["right_predictions"].show()
        out["crime_prediction"].show()
    elif a.cmd == "query":
        from civica.plans.catalogue import queries
        queries()[a.name](spark, a.tables).show(a.show, truncate=False)
    elif a.cmd == "explain":
        from civica.plans.catalogue import queries
        queries()[a.name](spark, a.tables).explain("formatted")
    return 0


if __name__ == "__main__":
    sys.exit(main())
