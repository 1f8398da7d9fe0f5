import datetime as dt

import numpy as np
import pytest

from tickloom.constants import LABEL, PREDICTION
from tickloom.operators import features, training
from tickloom.operators.transformers import SymbolScaler
from tickloom.sources import datasets

N = 120


@pytest.fixture(scope="module")
def made(spark):
    rng = np.random.default_rng(3)
    out = []
    for symbol in ("A_USDT_X", "B_USDT_X", "C_USDT_X"):
        price = 100 * np.exp(np.cumsum(rng.normal(0, 0.02, N)))
        for i in range(N):
            futures = None if i % 10 == 3 else float(price[i])
            out.append((symbol, dt.date(2023, 9, 1) + dt.timedelta(i), float(price[i]), futures, float("inf") if i == 5 else 1.0 + i, 5.0))
    schema = "symbol_id string, date date, close_spot double, close_futures double, volume_spot double, volume_futures double"
    days = spark.createDataFrame(out, schema)
    return features.build_features(days, features.feature_steps(None)).persist()


@pytest.mark.parametrize(
    "name, out",
    [
        ("close_spot", True), ("date", True), ("asset_id_base", True), ("futures_forward_returns_7", True),
        ("num_buys_7d", True), ("num_buys_7d_rz_30", False), ("total_dollar_volume_1d", True),
        ("total_dollar_volume_1d_zscore_30", False), ("basis_delta_1", True), ("basis_delta_1_rz_30", False),
        ("10th_percentile_dollar_volume_1d", True), ("spot_returns_1_percentile_30", False),
        ("90th_percentile_buy_dollar_volume_1d_rz_30", True), ("symbol_id", False), ("trade_imbalance_7d", False),
    ],
)
def test_columns_left_out(name, out):
    assert training.left_out(name) is out


def test_training_set_does_not_look_past_the_run_date(made):
    data = training.training_set(made, "2023-12-01")
    full = made.where("date < DATE'2023-12-01' AND close_futures IS NOT NULL")
    # Seven observed rows per symbol have no label yet (and the first ones no return).
    labelled = training.forward_label(training.with_futures(full)).where(f"{LABEL} IS NOT NULL")
    assert data.count() == labelled.count() > 0
    assert "close_futures" not in data.columns and LABEL in data.columns
    assert data.where("volume_spot = double('inf')").count() == 0


def test_only_on_the_first_of_a_month(made):
    assert training.train(made, "2023-12-02") is None


def test_train_save_load_predict(spark, made, tmp_path):
    root = str(tmp_path / "models")
    model = training.train(made, "2023-12-01", trees=3)
    datasets.save_model(model, root, "2023-12-01")
    assert datasets.latest_model_date(spark, root, "2023-11-30") is None
    assert datasets.latest_model_date(spark, root, "2023-12-15") == "2023-12-01"
    loaded = datasets.load_model(spark, root, "2023-12-15")
    day = made.where("date = DATE'2023-12-15'")
    got = sorted(tuple(r) for r in training.predict(day, loaded).collect())
    assert [r[0] for r in got] == ["A_USDT_X", "B_USDT_X", "C_USDT_X"]
    assert all(np.isfinite(r[2]) for r in got)
    again = training.train(made, "2023-12-01", trees=3)
    assert sorted(tuple(r) for r in training.predict(day, again).collect()) == got

    datasets.write_predictions(training.predict(day, loaded), str(tmp_path / "predictions"))
    back = spark.read.option("header", True).csv(str(tmp_path / "predictions"))
    assert back.count() == 3 and PREDICTION in back.columns


def test_unseen_symbol_is_scored(spark, made):
    model = training.train(made, "2023-12-01", trees=1)
    new = made.where("date = DATE'2023-12-15' AND symbol_id = 'A_USDT_X'").replace("A_USDT_X", "Z_USDT_X", "symbol_id")
    assert training.predict(new, model).count() == 1


def test_no_model_yet(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        datasets.load_model(spark, str(tmp_path), "2024-01-01")


def test_fitted_steps_are_kept_with_the_model(spark, made, tmp_path):
    root, run = str(tmp_path / "models"), "2023-12-01"
    scaler = SymbolScaler(inputCols=["spot_returns_7", "volume_spot"], outputCols=["a", "b"])
    model = training.train(made, run, trees=2, steps=[scaler])
    assert {"a", "b"} <= set(training.model_inputs(model))
    datasets.save_model(model, root, run)
    loaded = datasets.load_model(spark, root, run)
    later = made.where("date >= DATE'2023-12-01'")
    scored = lambda m: sorted(map(tuple, training.predict(later, m).collect()))
    assert scored(loaded) == scored(model) and len(scored(loaded)) > 0
    # The state is that of the training window, whatever is scored.
    steps, _ = training.split_stages(loaded)
    window = training.with_futures(training.training_window(made, run)).where("symbol_id = 'A_USDT_X'").toPandas()
    got = steps.transform(training.with_futures(later)).where("symbol_id = 'A_USDT_X'").toPandas()
    want = (got.volume_spot - window.volume_spot.mean()) / window.volume_spot.std()
    np.testing.assert_allclose(got.b, want, rtol=1e-9)


def test_scaler_of_odd_rows(spark):
    rows = [("A", 1.0), ("A", 3.0), ("A", float("nan")), ("B", 2.0), (None, 5.0), (None, 7.0)]
    fitted = SymbolScaler(inputCols=["x"], outputCols=["z"]).fit(spark.createDataFrame(rows, "symbol_id string, x double"))
    new = spark.createDataFrame([("A", 4.0), ("A", None), ("B", 2.0), ("C", 1.0), (None, 6.0)], "symbol_id string, x double")
    got = {(r["symbol_id"], r["x"]): r["z"] for r in fitted.transform(new).collect()}
    assert got.pop(("A", 4.0)) == pytest.approx(2**0.5)
    assert got == {("A", None): None, ("B", 2.0): None, ("C", 1.0): None, (None, 6.0): 0.0}
    assert fitted.transform(new.limit(0)).count() == 0
