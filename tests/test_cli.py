"""The command line runs prepare -> popularity / als / export on Parquet folders."""

import json

from pyspark.sql import functions as F

from encore.cli import main
from encore.sources.views import sales_interactions, track_catalogue

from conftest import SMALL


def test_cli_round_trip(spark, scratch, capsys):
    inter = sales_interactions(spark, SMALL).select(
        "user_id", F.col("item_id").cast("string").alias("recording_msid"), F.col("ts").alias("timestamp"),
        "l_orderkey", "l_linenumber")
    inter.write.parquet(f"{scratch}/interactions")
    track_catalogue(spark, SMALL).write.parquet(f"{scratch}/tracks")
    out = f"{scratch}/out"
    inter.filter("l_orderkey % 3 = 0").write.parquet(f"{scratch}/test_interactions")
    main(["prepare", "--interactions", f"{scratch}/interactions", "--tracks", f"{scratch}/tracks",
          "--out", out, "--support", "3,10", "--index-partitions", "4", "--order-cols", "user_id,recording_msid,l_orderkey,l_linenumber",
          "--test-interactions", f"{scratch}/test_interactions"], spark)
    stages = [json.loads(x) for x in capsys.readouterr().out.strip().splitlines()]
    assert [s["stage"] for s in stages][:2] == ["train", "val"]
    assert stages[0]["n_rows"] + stages[1]["n_rows"] == inter.dropDuplicates().count()
    main(["popularity", "--prepared", out, "--measure", "damped", "--beta", "500000"], spark)
    m = json.loads(capsys.readouterr().out.strip())
    assert 0 <= m["map_at_k"] <= 1 and m["n_users"] > 0
    main(["popularity", "--prepared", out, "--measure", "weighted", "--on", "test"], spark)
    assert json.loads(capsys.readouterr().out.strip())["n_users"] > 0
    for on in ("val", "train"):
        main(["popularity", "--prepared", out, "--sweep", "10,1000", "--on", on], spark)
        assert len(capsys.readouterr().out.strip().splitlines()) == 2
    assert spark.read.parquet(f"{out}/utility_val_filtered_10").count() < spark.read.parquet(f"{out}/utility_val_filtered").count()
    main(["als", "--prepared", out, "--rank", "4", "--max-iter", "2", "--k", "20", "--seed", "1", "--num-blocks", "4"], spark)
    assert json.loads(capsys.readouterr().out.strip())["n_users"] > 0
    main(["export", "--table", f"{out}/utility_train", "--order", "user_id,song_id", "--max-rows", "100", "--partitions", "4",
          "--out", f"{scratch}/export"], spark)
    assert json.loads(capsys.readouterr().out.strip())["rows"] == 100
