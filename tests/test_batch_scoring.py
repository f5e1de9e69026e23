"""How often features are built for batch scoring."""

from riskwatch.plans import catalog_model as CM


def test_batch_scoring_takes_the_features_of_the_training(spark, tmp_path, monkeypatch):
    """The features used to be built a second time for it, in full."""
    rows = spark.createDataFrame([(1, 0.5, 1), (2, None, None)], "customer_id long, x double, event_h12m int")
    for name in ("customer", "nation", "orders", "lineitem", "events"):
        rows.write.parquet(f"{tmp_path}/{name}.parquet")
    built, trained = [], []
    monkeypatch.setattr(CM.CF, "build_features", lambda spark, sf: built.append(sf) or rows)
    monkeypatch.setattr(CM.MD, "train_and_calibrate", lambda df, path, *_: trained.append(sorted(df.collect(), key=str)) or path)
    monkeypatch.setattr(CM.MD, "score_features", lambda path, df, *_: df)
    monkeypatch.setattr(CM, "_TRAINED", {})
    for _ in range(2):
        assert sorted(CM.q_model_score_batch(spark, str(tmp_path)).collect(), key=str) == trained[0]
    assert built == [str(tmp_path)] and len(trained) == 1 and len(trained[0]) == 2
