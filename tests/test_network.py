"""Network training against a replay in numpy."""

import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strata.operators import network as net
from strata.session import materialize


def points(spark, n=700, d=5):
    cols = [F.randn(10 + i) for i in range(d)]
    df = spark.range(n).select("id", F.array(*cols).alias("features"))
    s = F.col("features")
    return materialize(df.withColumn("label", ((s[0] + s[1] * s[2] + 0.3 * s[3]) > 0).cast("int")))


def local(rows, epoch, seed):
    """Rows in the epoch's order, sorted here."""
    got = rows.select(net.place_in_epoch(epoch, seed).alias("place"), "key", "x", "y").collect()
    got.sort(key=lambda r: (r["place"], r["key"], r["y"], r["x"]))
    return np.array([r["x"] for r in got]), np.array([r["y"] for r in got])


def plain_gradient(weights, offsets, x, y, alpha):
    """Mean loss gradient by textbook backpropagation, one row at a time."""
    gw, gb = [np.zeros_like(w) for w in weights], [np.zeros_like(b) for b in offsets]
    for row, label in zip(x, y):
        acts = [row]
        for k, (w, b) in enumerate(zip(weights, offsets)):
            z = acts[-1] @ w + b
            acts.append(np.maximum(z, 0) if k < len(weights) - 1 else 1 / (1 + np.exp(-z)))
        delta = acts[-1] - label
        for k in range(len(weights) - 1, -1, -1):
            gw[k] += np.outer(acts[k], delta)
            gb[k] += delta
            delta = (weights[k] @ delta) * (acts[k] > 0)
    n = len(y)
    return [(g + alpha * w) / n for g, w in zip(gw, weights)], [g / n for g in gb]


def replay(state, sizes, epochs, batches_of, rate=net.RATE, alpha=net.ALPHA):
    """Adam over the given batches, written out weight by weight."""
    flat = net.unflatten(state.weights.copy(), sizes)
    m, v = net.unflatten(state.m.copy(), sizes), net.unflatten(state.v.copy(), sizes)
    t = state.t
    for epoch in epochs:
        for x, y in batches_of(epoch):
            gw, gb = plain_gradient(flat[::2], flat[1::2], x, y, alpha)
            t += 1
            now = rate * math.sqrt(1 - 0.999 ** t) / (1 - 0.9 ** t)
            for k, g in enumerate(z for pair in zip(gw, gb) for z in pair):
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                flat[k] = flat[k] - now * m[k] / (np.sqrt(v[k]) + 1e-8)
    return np.concatenate([w.ravel() for w in flat]), t


def in_order(rows, size, seed):
    def batches(epoch):
        x, y = local(rows, epoch, seed)
        return [(x[a:a + size], y[a:a + size]) for a in range(0, len(y), size)]
    return batches


@pytest.mark.parametrize("slice_rows", [10 ** 6, 130])
def test_every_batch_is_an_update(spark, slice_rows):
    """epochs x ceil(n / 64) updates equal the replay, also when the epoch is
    cut in slices whose ends fall inside batches."""
    sizes = [5, 8, 4, 1]
    model = net.NetworkModel(sizes, net.State.fresh(net.first_weights(sizes, 1)))
    df = points(spark, 330)
    tuned = net.fine_tune(model, df, epochs=3, batch_rows=64, slice_rows=slice_rows, key_cols=["id"])
    rows = net.training_rows(df, key_cols=["id"])
    want, t = replay(model.state, sizes, range(3), in_order(rows, 64, 42))
    assert tuned.state.t == t == 3 * math.ceil(330 / 64)
    assert np.abs(tuned.state.weights - want).max() < 1e-9
    assert model.state.t == 0                                            # the old model is unchanged
    again = net.fine_tune(tuned, df, epochs=1, batch_rows=100, key_cols=["id"])
    more, t = replay(tuned.state, sizes, range(1), in_order(rows, 100, 42))
    assert again.state.t == t == tuned.state.t + 4                       # goes on with its moments
    assert np.abs(again.state.weights - more).max() < 1e-9


def test_gradients_summed_over_partitions(spark, monkeypatch):
    """Large batches: ranges of the permutation, gradients added as a tree."""
    monkeypatch.setattr(net, "TREE_WIDTH", 2)
    sizes = [5, 6, 1]
    rows = net.training_rows(points(spark, 500).repartition(9), key_cols=["id"])
    state, loss = net.run_epoch(rows, 500, net.State.fresh(net.first_weights(sizes, 2)), sizes, 0, 7, 200, parallel_rows=1)

    def ranges(epoch):
        got = rows.select(net._slice_of(net.place_in_epoch(epoch, 7), 3).alias("s"), "x", "y").collect()
        return [(np.array([r["x"] for r in got if r["s"] == k]), np.array([r["y"] for r in got if r["s"] == k])) for k in range(3)]

    want, t = replay(net.State.fresh(net.first_weights(sizes, 2)), sizes, range(1), ranges)
    assert state.t == t == 3 and np.abs(state.weights - want).max() < 1e-9 and 0 < loss < 5


def test_training_stops_by_the_rule_and_keeps_the_best(spark):
    df = points(spark, 600)
    model = net.train(df, 5, (16, 8), epochs=40, patience=4, batch_rows=32, rate=0.01, key_cols=["id"])
    scores, losses = [h["score"] for h in model.history], [h["loss"] for h in model.history]
    waited, best = 0, -math.inf
    for k, s in enumerate(scores):
        waited, best = (waited + 1 if s < best + net.TOL else 0), max(best, s)
        assert (waited > 4) == (k == len(scores) - 1 and len(scores) < 40)
    assert losses[-1] < losses[0] and best > 0.75
    rows = net.hold_out(net.training_rows(df, key_cols=["id"]), 0.1, 42)
    held = rows.filter("held")
    assert held.count() == 60
    assert net.accuracy(held, model.state, model.sizes) == pytest.approx(best)
    # loss curve equal to the replay's losses
    fit = rows.filter("NOT held")
    state = net.State.fresh(net.first_weights(model.sizes, 42))
    for epoch in range(2):
        x, y = local(fit, epoch, 42)
        total = 0.0
        for a in range(0, len(y), 32):
            bx, by = x[a:a + 32], y[a:a + 32]
            p = net.outputs(state.weights, model.sizes, bx)[-1][:, 0]
            total += -float((by * np.log(p) + (1 - by) * np.log(1 - p)).sum()) + state.penalty(model.sizes, net.ALPHA)
            w, t = replay(state, model.sizes, range(1), lambda _: [(bx, by)], rate=0.01)
            _, g = net.loss_and_gradient(state.weights, model.sizes, bx, by)
            state.step(model.sizes, g, len(by), 0.01, net.ALPHA)
            assert np.abs(state.weights - w).max() < 1e-9
        assert losses[epoch] == pytest.approx(total / len(y), rel=1e-9)


def test_model_scores_and_round_trip(spark, tmp_path):
    df = points(spark, 200)
    model = net.train(df, 5, (8,), epochs=3, key_cols=["id"])
    model.save(spark, str(tmp_path / "net"))
    back = net.NetworkModel.load(spark, str(tmp_path / "net"))
    assert back.state.t == model.state.t and np.array_equal(back.state.v, model.state.v)
    a = {r["id"]: (r["probability"][1], r["prediction"]) for r in model.transform(df).collect()}
    x = df.collect()
    p = net.outputs(back.state.weights, back.sizes, np.array([r["features"] for r in x]))[-1][:, 0]
    assert all(abs(a[r["id"]][0] - q) < 1e-12 and a[r["id"]][1] == float(q > 0.5) for r, q in zip(x, p))
    with pytest.raises(ValueError):
        net.train(df.filter("id < 0"), 5, (8,))
    assert net.fine_tune(model, df.filter("id < 0")).state.t == model.state.t


def test_steps_are_in_place_and_own_their_arrays():
    """Views of the weights follow the steps; the arrays given do not change."""
    sizes, rng = [3, 4, 1], np.random.default_rng(3)
    first = net.first_weights(sizes, 5)
    kept, state = first.copy(), net.State.fresh(first)
    layers, gradient = net.unflatten(state.weights, sizes), np.empty_like(first)
    m = v = np.zeros_like(first)
    want = first.copy()
    for t in range(1, 4):
        x, y = rng.normal(size=(8, 3)), np.arange(8) % 2.0
        loss, g = net.loss_and_gradient(want, sizes, x, y)
        assert net.gradient_into(net.unflatten(gradient, sizes), layers, x, y) == loss
        np.testing.assert_array_equal(gradient, g)
        before, copy = state.weights.copy(), state.own()
        state.step(sizes, gradient, 8, 0.01, 0.0)
        np.testing.assert_array_equal(copy.weights, before)
        g = g / 8
        m, v = net.BETA1 * m + (1 - net.BETA1) * g, net.BETA2 * v + (1 - net.BETA2) * g * g
        now = 0.01 * np.sqrt(1 - net.BETA2 ** t) / (1 - net.BETA1 ** t)
        want = want - now * m / (np.sqrt(v) + net.EPSILON)
        np.testing.assert_allclose(state.weights, want, rtol=1e-14, atol=1e-16)
    np.testing.assert_array_equal(first, kept)


def test_updates_in_buffers_equal_plain_steps():
    """Fused updates, the last batch not full, against gradient and step."""
    sizes, rng = [6, 9, 4, 1], np.random.default_rng(4)
    plain = net.State.fresh(net.first_weights(sizes, 5))
    plain.step(sizes, rng.normal(size=len(plain.weights)), 3, 0.01, 0.1)            # moments to go on from
    kept, fused = plain.own(), net.Updates(plain, sizes, 16, 0.01, 0.1)
    x, y = rng.normal(size=(60, 6)), np.arange(60) % 2.0
    ones = np.column_stack([x, np.ones(60)])
    for at in range(0, 60, 16):
        want, g = net.loss_and_gradient(plain.weights, sizes, x[at:at + 16], y[at:at + 16])
        want += plain.penalty(sizes, 0.1)
        plain.step(sizes, g, len(y[at:at + 16]), 0.01, 0.1)
        assert fused.update(ones[at:at + 16], y[at:at + 16]) == pytest.approx(want, rel=1e-12)
        got = fused.state()
        assert got.t == plain.t
        for name in ("weights", "m", "v"):
            np.testing.assert_allclose(getattr(got, name), getattr(plain, name), rtol=1e-10, atol=1e-13)
    np.testing.assert_array_equal(kept.weights, net.Updates(kept, sizes, 16, 0.01, 0.1).state().weights)


@pytest.mark.parametrize("slice_rows", [10 ** 6, 130])
def test_epochs_sorted_ahead_give_the_same_updates(spark, monkeypatch, slice_rows):
    """Packed epochs hold every row once, in the order of the plain sort; the
    stage tables of epochs that are over are gone."""
    from strata import session
    sizes, df = [5, 8, 4, 1], points(spark, 330)
    model = net.NetworkModel(sizes, net.State.fresh(net.first_weights(sizes, 1)))
    want = net.fine_tune(model, df, epochs=3, batch_rows=64, slice_rows=slice_rows, key_cols=["id"])
    monkeypatch.setattr(net, "AHEAD_BYTES", 0)
    monkeypatch.setattr(net, "PACKED_BYTES", 7 * 40)
    before = len(session._WRITTEN[spark.sparkContext.applicationId])
    got = net.fine_tune(model, df, epochs=3, batch_rows=64, slice_rows=slice_rows, key_cols=["id"])
    np.testing.assert_array_equal(got.state.weights, want.state.weights)
    assert got.history == want.history
    trained = net.train(df, 5, (8,), epochs=4, key_cols=["id"], patience=0, slice_rows=slice_rows)
    assert len(trained.history) >= 2 and len(session._WRITTEN[spark.sparkContext.applicationId]) == before
    rows = net.training_rows(df, key_cols=["id"])
    blocks = net._packed(rows, 2, 42, 3, 5)
    x, y = net._unpacked(blocks.orderBy("slice", "range", "at").toArrow(), 5)
    wx, wy = local(rows, 2, 42)
    np.testing.assert_array_equal(x, np.column_stack([wx, np.ones(330)]))
    np.testing.assert_array_equal(y, wy)
    assert max(len(r["y"]) // 8 for r in blocks.collect()) <= 7


@pytest.mark.parametrize("kind", [pa.binary(), pa.large_binary()])
def test_packed_blocks_are_read_as_views(kind):
    """Also of sliced and empty tables, and with 64-bit offsets."""
    x, y = np.arange(24.0).reshape(8, 3), np.arange(8) % 2.0
    blocks = pa.table({"x": pa.array([x[a:a + 3].tobytes() for a in range(0, 8, 3)], kind),
                       "y": pa.array([y[a:a + 3].tobytes() for a in range(0, 8, 3)], kind)})
    for table, at in ((blocks, 0), (blocks.slice(1), 3), (blocks.slice(3), 8), (pa.concat_tables([blocks.slice(0, 1), blocks.slice(1)]), 0)):
        gx, gy = net._unpacked(table, 2)
        np.testing.assert_array_equal(gx, x[at:])
        np.testing.assert_array_equal(gy, y[at:])
