"""The trained models against plain forward passes and finite differences, the flow against all flows."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from markerloom.llm import language_id, mixing, quality


def plain_convolution(net, window):
    """Softmax of one window, filter by filter and place by place."""
    p, pooled = net.params, []
    for w in language_id.WIDTHS:
        for f in range(net.filters):
            pooled.append(max(sum(p["E"][window[at + t]] @ p[f"K{w}"][t][:, f] for t in range(w)) for at in range(len(window) - w + 1)) + p[f"b{w}"][f])
    s = np.maximum(np.array(pooled), 0) @ p["O"] + p["c"]
    s = np.exp(s - s.max())
    return s / s.sum()


def trained_net():
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.integers(97, 110, (40, language_id.WINDOW)), rng.integers(105, 122, (40, language_id.WINDOW))]).astype(np.uint8)
    return language_id.ByteConvNet(["a", "b"]).fit(x, np.repeat([0, 1], 40), epochs=2), x


def test_table_responses_equal_a_plain_convolution():
    net, x = trained_net()
    some = x[[0, 1, 50]]
    assert np.allclose(language_id.responses(net.tables(), some), [plain_convolution(net, w) for w in some], atol=1e-5)


def finite_difference(loss, params, key, at, step=1e-5):
    held = params[key][at]
    params[key][at] = held + step
    up = loss()
    params[key][at] = held - step
    down = loss()
    params[key][at] = held
    return (up - down) / (2 * step)


def test_network_gradients_equal_finite_differences():
    net, x = trained_net()
    x, y = x[[0, 5, 44, 70]], np.array([0, 1, 1, 0])
    grads = net._gradients(x, y)
    loss = lambda: -np.mean([np.log(plain_convolution(net, w)[k]) for w, k in zip(x, y, strict=True)]) + 5e-5 * (net.params["O"] ** 2).sum()
    places = {"O": (3, 1), "c": (0,), "b3": (2,), "K2": (1, 4, 3), "K4": (0, 2, 5), "E": (int(x[0, 7]), 3)}
    for key, at in places.items():
        assert grads[key][at] == pytest.approx(finite_difference(loss, net.params, key, at), abs=1e-6)


def plain_score(net, data):
    """Score of one text, passage by passage."""
    p, hs, es = net.params, [], []
    for at in range(0, max(1, len(data)), quality.PASSAGE):
        h = np.tanh(quality.features([data[at : at + quality.PASSAGE]])[0][0] @ p["W"] + p["b"])
        hs.append(h)
        es.append(sum(np.tanh(h @ p["V"])[k] / (1 + np.exp(-(h @ p["U"])[k])) * p["w"][k] for k in range(len(p["w"]))))
    a = np.exp(np.array(es)) / np.exp(np.array(es)).sum()
    return 1 / (1 + np.exp(-(a @ np.array(hs) @ p["o"] + p["c"][0])))


def test_attention_score_equals_a_plain_pass_also_in_stretches():
    rng = random.Random(3)
    texts = [b"", b"short", *[bytes(rng.choice(b"abc def.\n") for _ in range(n)) for n in (512, 513, 3000, 9000)]]
    net = quality.AttentionBag(quality.features([b""])[0].shape[1])
    want = [plain_score(net, t) for t in texts]
    assert np.allclose(net.score(*quality.features(texts)), want)
    assert np.allclose([net.score_in_stretches(t, 2 * quality.PASSAGE) for t in texts], want)


def test_attention_gradients_equal_finite_differences():
    rng = random.Random(4)
    texts = [bytes(rng.choice(b"abc def.\n") for _ in range(n)) for n in (400, 1500, 2600)]
    x, counts = quality.features(texts)
    x, y, weight = x.astype(np.float64), np.array([1.0, 0.0, 1.0]), np.array([1.0, 2.0, 1.0])
    net = quality.AttentionBag(x.shape[1])
    grads = net.gradients(x, counts, y, weight)

    def loss():
        s = net.score(x, counts)
        return -np.mean(weight * (y * np.log(s) + (1 - y) * np.log(1 - s))) + 5e-6 * (net.params["W"] ** 2).sum()

    for key, at in {"o": (3,), "c": (0,), "w": (2,), "V": (4, 1), "U": (5, 7), "W": (97, 2), "b": (6,)}.items():
        assert grads[key][at] == pytest.approx(finite_difference(loss, net.params, key, at), abs=1e-7)


def test_flow_is_the_cheapest_of_all_flows():
    rng = random.Random(5)
    names = ("x", "y")
    for _ in range(40):
        patterns = [(tuple(s for s in names if rng.random() < 0.7) or ("x",), rng.randint(1, 3)) for _ in range(rng.randint(1, 3))]
        quotas = {s: rng.randint(0, 6) for s in names}
        cost = lambda sent: sum(max(0, t - n) for t, (_, n) in zip(sent, patterns, strict=True))  # noqa: E731  a second pass costs one a token
        options = [[c for c in itertools.product(*[range(2 * n + 1) if s in members else (0,) for s in names]) if sum(c) <= 2 * n] for members, n in patterns]
        best = min(
            (-sum(map(sum, sent)), cost([sum(c) for c in sent]))
            for sent in itertools.product(*options) if all(sum(c[k] for c in sent) <= quotas[s] for k, s in enumerate(names))
        )
        flow = mixing.route(patterns, quotas, 2)
        assert all(sum(f.get(s, 0) for f in flow) <= quotas[s] for s in names)
        assert (-sum(sum(f.values()) for f in flow), cost([sum(f.values()) for f in flow])) == best


def test_mix_counts_repeated_rows_one_by_one_and_closes_every_gap(spark):
    sized = lambda data: spark.createDataFrame(data, "doc_id long, size long, source string").select("doc_id", "size", F.array("source").alias("sources"))
    got = mixing.mix_sources(sized([(1, 30, "a")] * 5), lambda sizes: {"a": 65.0}).collect()
    assert sorted(r.taken for r in got) == [0, 0, 0, 30, 30]
    rng = random.Random(6)
    data = [(k if k % 7 else None, rng.randint(1, 40), f"s{k % 3}") for k in range(300)]
    wanted = {"s0": 517.0, "s1": 2900.0, "s2": 3333.0}
    for bucket_docs in (8, 4096):
        rows = mixing.mix_sources(sized(data), lambda sizes: wanted, bucket_docs=bucket_docs).select("doc_id", "size", "taken", F.get("mixed.members", F.lit(0))["source"].alias("source")).collect()
        assert len(rows) == len(data)
        for s, target in wanted.items():
            mine = [r for r in rows if r.source == s]
            size, taken = sum(r["size"] for r in mine), sum(r.taken for r in mine)
            full = int(target // size)
            again = [r["size"] for r in mine if r.taken == full * r["size"]]
            assert taken <= target and all(r.taken in (full * r["size"], (full + 1) * r["size"]) for r in mine)
            assert taken == min(2 * size, int(target)) or target - taken < min(again)
