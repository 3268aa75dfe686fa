"""Command line: run the preparation, popularity, ALS and export steps on Parquet paths.

    python -m encore prepare --interactions in/interactions --tracks in/tracks --out out/ \
        --support 3,10,15,30 --index-partitions 64
    python -m encore popularity --prepared out/ --measure damped --beta 500000
    python -m encore popularity --prepared out/ --sweep 50000,60000,70000
    python -m encore als --prepared out/ --rank 40 --reg 0.2 --alpha 1.0 --max-iter 10 --seed 42 \
        --num-blocks 64
    python -m encore export --table out/utility_train_filtered --order user_id,song_id \
        --max-rows 55000000 --partitions 64 --out out/utility_train_export

On a cluster: ``spark-submit --py-files encore.zip encore/cli.py <command> ...`` with
``spark.checkpoint.dir`` set to a shared folder.

Tables are Parquet folders; metrics are printed as one JSON line per row.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession


def _split_list(text: str) -> list[str]:
    return [t.strip() for t in text.split(",") if t.strip()]


def _print_rows(df) -> None:
    for row in df.collect():  # metric tables: one row per group
        print(json.dumps(row.asDict(), default=str))


def cmd_prepare(spark: SparkSession, a: argparse.Namespace) -> None:
    from encore.plans.flows import prepare, stage_report
    from encore.operators.labels import label_arrays, label_lists
    from encore.sources.sinks import write_by_user, write_parquet
    interactions = spark.read.parquet(a.interactions)
    tracks = spark.read.parquet(a.tracks)
    p = prepare(interactions, tracks, user_col=a.user_col, item_key=a.item_col,
                track_key=a.track_key, split_keys=_split_list(a.order_cols) if a.order_cols else None,
                how=a.how, frac=a.train_fraction, support=[int(t) for t in _split_list(a.support)], label_k=a.label_k,
                num_partitions=a.index_partitions, materialize_stages=True)
    out = a.out.rstrip("/")
    write_parquet(p.tracks, f"{out}/tracks_indexed")
    write_parquet(p.utility_train, f"{out}/utility_train")
    write_parquet(p.utility_val, f"{out}/utility_val")
    for n, (t, (train, val)) in enumerate(p.filtered.items()):
        # the first threshold's tables are the ones the other commands read by default
        end = f"_{t}" if n else ""
        write_by_user(train, f"{out}/utility_train_filtered{end}", a.user_col)
        write_by_user(val, f"{out}/utility_val_filtered{end}", a.user_col)
    write_parquet(p.labels_val, f"{out}/labels_val")
    write_parquet(label_lists(p.utility_train, a.label_k, a.user_col, "song_id"), f"{out}/labels_train")
    write_parquet(label_arrays(p.labels_val, a.label_k, a.user_col, "song_id"), f"{out}/selected_val")
    if a.test_interactions:
        from encore.plans.flows import prepare_holdout
        h = prepare_holdout(spark.read.parquet(a.test_interactions), p.tracks, user_col=a.user_col,
                            item_key=a.item_col, track_key=a.track_key, how=a.how, label_k=a.label_k)
        write_parquet(h.utility, f"{out}/utility_test")
        write_parquet(h.labels, f"{out}/labels_test")
    _print_rows(stage_report(p, a.user_col))
    p.release()


def _prepared(spark: SparkSession, base: str, on: str = "val"):
    """(filtered train utility, evaluation utility, evaluation labels); ``on='test'``
    scores against the held-out test set written by ``prepare --test-interactions``,
    ``on='train'`` against the training labels."""
    base = base.rstrip("/")
    train = spark.read.parquet(f"{base}/utility_train_filtered")
    if on == "train":
        return train, train, spark.read.parquet(f"{base}/labels_train")
    if on == "test":
        return train, spark.read.parquet(f"{base}/utility_test"), spark.read.parquet(f"{base}/labels_test")
    return (train, spark.read.parquet(f"{base}/utility_val_filtered"),
            spark.read.parquet(f"{base}/labels_val"))


def cmd_popularity(spark: SparkSession, a: argparse.Namespace) -> None:
    from encore.operators.metrics import shared_list_metrics
    from encore.operators.popularity import beta_sweep_top_k, popularity_top_k
    train, _, labels = _prepared(spark, a.prepared, a.on)
    if a.sweep:
        betas = [float(b) for b in _split_list(a.sweep)]
        top = beta_sweep_top_k(train, betas, a.k, a.measure, item_col="song_id")
        m = shared_list_metrics(top, labels, a.k, group_cols=["beta"], user_col=a.user_col, item_col="song_id")
    else:
        top = popularity_top_k(train, a.k, a.measure, a.beta, item_col="song_id")
        m = shared_list_metrics(top, labels, a.k, user_col=a.user_col, item_col="song_id")
    _print_rows(m)


def cmd_als(spark: SparkSession, a: argparse.Namespace) -> None:
    from encore.operators.als import als_grid
    train, val, labels = _prepared(spark, a.prepared, a.on)
    m = als_grid(train, val.select(a.user_col), labels,
                 [int(r) for r in _split_list(a.rank)], [float(r) for r in _split_list(a.reg)],
                 [float(x) for x in _split_list(a.alpha)], a.k, a.max_iter, seed=a.seed, num_blocks=a.num_blocks,
                 user_col=a.user_col, item_col="song_id")
    _print_rows(m)


def cmd_export(spark: SparkSession, a: argparse.Namespace) -> None:
    from encore.sources.sinks import bounded_export
    df = spark.read.parquet(a.table)
    bounded_export(df, _split_list(a.order), a.max_rows, a.out, num_partitions=a.partitions)
    print(json.dumps({"written": a.out, "rows": spark.read.parquet(a.out).count()}))


def build_parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="encore")
    sub = ap.add_subparsers(dest="command", required=True)

    p = sub.add_parser("prepare", help="clean, index, split, utility, support filter, labels")
    p.add_argument("--interactions", required=True)
    p.add_argument("--tracks", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--test-interactions", default=None, help="held-out test interactions (optional)")
    p.add_argument("--user-col", default="user_id")
    p.add_argument("--item-col", default="recording_msid")
    p.add_argument("--track-key", default="recording_msid")
    p.add_argument("--order-cols", default=None, help="split order keys (default: all columns)")
    p.add_argument("--how", default="any", choices=["any", "all"])
    p.add_argument("--train-fraction", type=float, default=0.8)
    p.add_argument("--support", default="3", help="comma-separated support thresholds")
    p.add_argument("--index-partitions", type=int, required=True,
                   help="ranges numbered side by side; catalogue bytes / 256 MB is a good value")
    p.add_argument("--label-k", type=int, default=100)

    q = sub.add_parser("popularity", help="popularity baseline metrics")
    q.add_argument("--prepared", required=True)
    q.add_argument("--measure", default="damped", choices=["damped", "weighted"])
    q.add_argument("--beta", type=float, default=0)
    q.add_argument("--sweep", default=None, help="comma-separated betas")
    q.add_argument("--k", type=int, default=100)
    q.add_argument("--user-col", default="user_id")
    q.add_argument("--on", default="val", choices=["val", "test", "train"])

    r = sub.add_parser("als", help="implicit ALS fit + validation metrics (grid over lists)")
    r.add_argument("--prepared", required=True)
    r.add_argument("--rank", default="40")
    r.add_argument("--reg", default="0.2")
    r.add_argument("--alpha", default="1.0")
    r.add_argument("--max-iter", type=int, default=10)
    r.add_argument("--seed", type=int, required=True, help="required: fits are reproducible")
    r.add_argument("--num-blocks", type=int, required=True, help="required: equal blocks and seed give equal fits")
    r.add_argument("--k", type=int, default=100)
    r.add_argument("--user-col", default="user_id")
    r.add_argument("--on", default="val", choices=["val", "test", "train"])

    e = sub.add_parser("export", help="deterministic bounded export of a table")
    e.add_argument("--table", required=True)
    e.add_argument("--order", required=True)
    e.add_argument("--max-rows", type=int, required=True)
    e.add_argument("--out", required=True)
    e.add_argument("--partitions", type=int, required=True, help="ranges numbered side by side")
    return ap


COMMANDS = {"prepare": cmd_prepare, "popularity": cmd_popularity, "als": cmd_als, "export": cmd_export}


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = build_parser().parse_args(argv)
    if spark is None:
        from encore.session import build_session
        spark = build_session(app_name=f"encore-{args.command}")
    COMMANDS[args.command](spark, args)


if __name__ == "__main__":
    main(sys.argv[1:])
