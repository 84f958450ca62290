"""Published models: the newest whole one is served, whatever was torn."""

import random
import time

import pytest

from affinity.operators import model
from affinity.operators.registry import KEEP, Entry, Registry


def made(spark, seed):
    rng = random.Random(seed)
    users = [(u, rng.uniform(-1, 1)) for u in range(30)]
    items = [(m, rng.uniform(-2, 2)) for m in range(20)]
    return model.Model(
        spark.createDataFrame(users, "userId int, factor double"),
        spark.createDataFrame(items, "movieId int, factor double"), 0.01, 10, 0.9,
    )


def test_an_empty_registry_has_no_model(spark, workspace):
    with pytest.raises(LookupError):
        model.current_path(spark, workspace.path("empty"))


def test_a_torn_publish_is_never_served(spark, workspace):
    root = workspace.path("torn")
    good = model.publish(made(spark, 1), root)
    registry = Registry(spark, root)
    # A publisher that dies while it saves leaves no entry.
    with pytest.raises(RuntimeError):
        registry.publish(made(spark, 2).users, made(spark, 2).items, lambda path: (_ for _ in ()).throw(RuntimeError()))
    assert registry.current().path == good
    # An entry without its model, with half of it, with other rows, and one that is no entry.
    half = f"{root}/models/half"
    made(spark, 3).users.write.parquet(f"{half}/users")
    other = f"{root}/models/other"
    model.save(made(spark, 4), other)
    entry = registry.read(registry.names()[0])
    for path in (f"{root}/models/none", half, other):
        registry.append(Entry(path, entry.users, entry.items, entry.users_sum, entry.items_sum))
    fs = registry._fs()
    fs.create(registry._path("log", f"e-{time.time_ns():020d}-torn")).close()
    fs.create(registry._path("log", "_e-draft")).close()
    assert registry.current().path == model.current_path(spark, root) == good
    newest = model.publish(made(spark, 5), root)
    assert registry.current().path == newest


def test_what_was_saved_must_be_what_was_given(spark, workspace):
    root = workspace.path("lossy")
    m = made(spark, 1)
    lossy = model.Model(m.users.limit(3), m.items, m.lam, m.iterations, m.rmse)
    with pytest.raises(OSError):
        Registry(spark, root).publish(m.users, m.items, lambda path: model.save(lossy, path))
    assert Registry(spark, root).names() == []


def test_the_log_stays_short(spark, workspace):
    root = workspace.path("short")
    paths = [model.publish(made(spark, seed), root) for seed in range(KEEP + 3)]
    registry = Registry(spark, root)
    assert [registry.read(n).path for n in registry.names()] == paths[: -KEEP - 1 : -1]
    models = registry._fs().listStatus(registry._path("models"))
    assert sorted(s.getPath().getName() for s in models) == sorted(p.rsplit("/", 1)[1] for p in paths[-KEEP:])


def test_a_model_is_checked_once(spark, workspace, monkeypatch):
    root = workspace.path("once")
    model.publish(made(spark, 1), root)
    registry = Registry(spark, root)
    registry.current()
    monkeypatch.setattr("affinity.operators.registry.facts", lambda side: pytest.fail("checked again"))
    assert registry.current() == registry.current()
