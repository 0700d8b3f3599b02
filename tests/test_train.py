from tenura.plans import models_q, registry
from tenura.sources.warehouse import Warehouse


def test_run_has_cross_validation_upserted_scores_and_importance(spark, data_dir):
    summary = registry.queries()["train_summary"](spark, data_dir).first()
    cv = {r.model_name: (r.cv_auc_mean, r.cv_auc_std) for r in summary.comparison}
    assert set(cv) == set(summary.models) and cv.pop("neural_net") == (None, None)
    assert len(cv) == 3 and all(0.3 < mean <= 1 and 0 <= std < 0.5 for mean, std in cv.values())
    w = Warehouse.open(spark, data_dir)
    t = models_q.trained(w)
    written = spark.read.parquet(f"{w.folder}/model_scores")
    assert written.count() == len(t.models) * w.mart().count()
    own = t.rows.select("customer_id", "model_name", "p")
    assert own.exceptAll(written.selectExpr("customer_id", "model_name", "churn_probability")).isEmpty()
    drops = registry.queries()["train_importance"](spark, data_dir)
    assert drops.count() == len(models_q._inputs)
