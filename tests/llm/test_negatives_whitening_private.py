"""Hard negatives, whitening and personal data against brute force and planted cases."""

import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from scriptloom.llm import hard_negatives, private_data, whitening
from scriptloom.llm import queries as registered

VECTORS = "vec_id long, embedding array<double>, label int, v string, n int, score string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, label, "x", 1, "y") for i, v, label in rows], VECTORS)


# --- hard negatives ---------------------------------------------------------------------------


def brute_negatives(rows, scale=256, every=100, k=5, low=80):
    """Nested loops over plain integers."""
    kept = {}
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        kept[i] = max(kept.get(i, (label, v)), (label, v))
    ints = {i: (label, [int(np.floor(scale * x)) for x in v]) for i, (label, v) in kept.items()}
    out = []
    for a, (label, v) in ints.items():
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i, other) for i, (other, w) in ints.items() if i != a)
        for ps, p, _ in [s for s in scored if s[2] == label][:k]:
            fitting = [s for s in scored if s[2] != label and low * -ps <= 100 * -s[0] <= 100 * -ps][:k]
            out += [(a, p, r + 1, i, -ps, -s) for r, (s, i, _) in enumerate(fitting)]
    return sorted(out)


def negatives(df, **options):
    rows = hard_negatives.hard_negatives(df, **options).collect()
    return sorted(tuple(r[c] for c in ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")) for r in rows)


def vectors(n, dimension, seed, spread=0.4):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=dimension)
    return [(i, (centre + spread * rng.normal(size=dimension)).tolist(), int(rng.integers(0, 3))) for i in range(n)]


@pytest.mark.parametrize("dimension", [1, 8, 13])
def test_negatives_match_nested_loops(spark, dimension):
    rows = vectors(420, dimension, dimension)
    rows += [(1000 + i, rows[7][1], i % 2) for i in range(40)]  # equal scores: ties go by id
    rows += [(None, rows[0][1], 1), (5000, None, 1), (5001, [None] * dimension, 1), (5002, rows[0][1], None)]
    rows += [(5003, [float("nan")] * dimension, 1), (5004, [float("inf")] * dimension, 1), (5005, [1.0] * (dimension + 1), 1)]
    want = brute_negatives([r for r in rows if r[0] != 5005])
    assert want and negatives(frame(spark, rows).repartition(5)) == want


def test_negatives_in_waves_and_with_repeated_rows(spark):
    rows = vectors(900, 6, 3)
    want = brute_negatives(rows)
    assert negatives(frame(spark, rows + rows), wave_bytes=6 * 8 * 2) == want
    again = rows + [(i, [-x for x in v], label) for i, v, label in rows[::3]]
    assert negatives(frame(spark, again)) == brute_negatives(again)


@pytest.mark.parametrize("size", [1e5, 1e9, 1e12])
def test_negatives_of_large_components(spark, size):
    rows = [(i, [x * size for x in v], label) for i, v, label in vectors(230, 4, 9)]
    want = brute_negatives(rows)
    fits = [w if max(abs(w[4]), abs(w[5])) < 1 << 63 else (*w[:4], None, None) for w in want]
    got = negatives(frame(spark, rows)) if size < 1e10 else hard_negatives.hard_negatives(frame(spark, rows)).collect()
    if size < 1e10:
        assert got == fits
    else:  # scores pass 64 bits: chosen exactly, returned as null
        assert sorted(tuple(r)[:4] for r in got) == [w[:4] for w in want]
        assert all(r["positive_score"] is None for r in got)


def test_negatives_of_few_rows(spark):
    assert negatives(frame(spark, [])) == []
    assert negatives(frame(spark, [(0, [1.0], 0), (1, [1.0], 1)])) == []  # no positive
    assert negatives(frame(spark, [(0, [1.0], 0), (1, [1.0], 0), (2, [0.9], 1)])) == [(0, 1, 1, 2, 65536, 58880)]


def test_planes_and_tables_give_products():
    rng = np.random.default_rng(4)
    for size in (1, 300, 1 << 40):
        a, b = rng.integers(-size, size + 1, (5, 11)), rng.integers(-size, size + 1, (50, 11))
        planes = hard_negatives.bit_planes(np.pad(b, ((0, 0), (0, 5))))
        kind = hard_negatives.number_kind(int(np.abs(a).sum(axis=1).max()), len(planes))
        got = hard_negatives.scores(hard_negatives.subset_sums(a.astype(kind)), planes)
        assert (got == b.astype(object) @ a.T.astype(object)).all()


# --- whitening --------------------------------------------------------------------------------


def whitened(spark, rows, **options):
    df = whitening.whiten(frame(spark, [(i, v, 0) for i, v in rows]), **options)
    return sorted(df.collect(), key=lambda r: (r["vec_id"] is None, r["vec_id"]))


def check_whitened(rows, got, components=16):
    used = [(i, [int(np.floor(64 * c)) + 1_000_000 for c in v]) for i, v in rows]
    used.sort(key=lambda r: (r[0] is None, r[0]))
    fit = np.array(sorted({tuple(x) for _, x in used}), dtype=object)
    n, sums = len(fit), fit.sum(axis=0)
    z = ((n * fit - sums) / n).astype(float)
    values, axes = np.linalg.eigh(z.T @ z / n)
    values = values[::-1][:components]
    real = values > 1e-9 * max(values[0], 1e-300)
    trace = float((z**2).sum() / n)
    assert [r["vec_id"] for r in got] == [i for i, _ in used]
    y = np.array([r["whitened"] for r in got])
    assert y.shape[1] == real.sum()
    for row, (_, x) in zip(got, used):
        assert row["n"] == n and row["deviation"] == sum((n * a - s) ** 2 for a, s in zip(x, sums))
        assert np.allclose(row["explained"], values[real] / trace, rtol=1e-9)
        assert row["identity_error"] < 1e-7
    first = {tuple(x): at for at, (_, x) in enumerate(used)}
    chosen = y[sorted(first.values())]
    assert np.allclose(chosen.T @ chosen / n, np.eye(y.shape[1]), atol=1e-7)
    # distances along one component agree up to sign wherever its value stands alone
    for k in range(y.shape[1]):
        near = np.delete(np.linalg.eigvalsh(z.T @ z / n)[::-1], k)
        if np.abs(near - values[k]).min(initial=np.inf) > 1e-6 * values[0]:
            exact = ((np.array([x for _, x in used], dtype=object) * n - sums) / n).astype(float) @ axes[:, ::-1][:, k]
            assert np.allclose(np.abs(exact / values[k] ** 0.5), np.abs(y[:, k]), atol=1e-7)


@pytest.mark.parametrize("dimension", [1, 5, 24])
def test_whitening_matches_eigenvectors(spark, dimension):
    rng = np.random.default_rng(dimension)
    rows = [(i, (rng.normal(size=dimension) * np.linspace(3, 0.2, dimension)).tolist()) for i in range(150)]
    rows += rows[:40] + [(None, rows[0][1])]
    check_whitened(rows, whitened(spark, rows))


def test_whitening_of_equal_values_and_dependent_columns(spark):
    spikes = [(8 * s + i, [float(s * 4) if i == j else 1.0 for j in range(8)]) for i in range(8) for s in (0, 1)]
    check_whitened(spikes, whitened(spark, spikes))
    rng = np.random.default_rng(0)
    flat = [(i, [float(a), float(a), float(b), 2.0, float(a + b)]) for i, (a, b) in enumerate(rng.integers(-9, 9, (60, 2)))]
    got = whitened(spark, flat)
    assert len(got[0]["whitened"]) == 2
    check_whitened(flat, got)


def test_whitening_far_from_the_origin_and_of_large_entries(spark):
    rng = np.random.default_rng(1)
    check_whitened(far := [(i, (1e6 + rng.normal(size=4)).tolist()) for i in range(80)], whitened(spark, far))
    huge = [(i, (1e9 * rng.normal(size=3)).tolist()) for i in range(50)]
    got = whitened(spark, huge)
    assert all(r["deviation"] is None for r in got) and got[0]["identity_error"] < 1e-9


def test_whitening_of_unusable_and_few_rows(spark):
    assert whitened(spark, []) == []
    nothing = [(1, None), (2, [None, 1.0]), (3, [float("nan"), 1.0]), (4, [float("inf"), 0.0]), (5, [1e300, 0.0])]
    assert whitened(spark, nothing) == []
    one = whitened(spark, [*nothing, (7, [1.0, 2.0]), (8, [1.0, 2.0])])
    assert [(r["vec_id"], r["n"], r["deviation"], r["whitened"]) for r in one] == [(7, 1, 0, []), (8, 1, 0, [])]


def test_steps_stop_when_the_rest_is_small():
    rng = np.random.default_rng(6)
    x = rng.normal(size=(300, 40)) * 0.5 ** np.arange(40)
    x -= x.mean(axis=0)
    steps = []

    def products(w_all, w):
        steps.append(1)
        u = x @ w
        return (x @ w_all).T @ u, float(u @ u), x.T @ u

    axes, values = whitening.bidiagonal(products, 40, float((x**2).sum()), 300, 5)
    _, exact, right = np.linalg.svd(x, full_matrices=False)
    assert len(steps) < 40
    assert np.allclose(values[:5], exact[:5], rtol=1e-12)
    assert np.allclose(np.abs((right[:5] @ axes[:, :5])), np.eye(5), atol=1e-10)


# --- personal data ----------------------------------------------------------------------------


@pytest.fixture(scope="module")
def field():
    return private_data.train()


def brute_base(text):
    """The patterns as they are defined, tried at every place."""
    digits = lambda s: re.sub("[^0-9]", "", s)

    def luhn(number):
        doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(number))]
        return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0

    found = [(m.span(), "email") for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(part) <= 255 for part in m.group().split(".")):
            found.append((m.span(), "ip"))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        if 12 <= len(digits(m.group())) <= 19 and luhn(digits(m.group())):
            found.append((m.span(), "card"))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(digits(m.group())) <= 15:
            found.append((m.span(), "phone"))
    return sorted(((a, b, k) for (a, b), k in found), key=lambda s: (s[0], private_data.KINDS.index(s[2])))


PARTS = ("1", "23", "256", "007", ".", ".", "@", "a", "-", "+", "(", ")", " ", "4111111111111111", "x.y", "%", "é", "\n", "😀")


def test_patterns_match_brute_force():
    rnd = random.Random(3)
    for _ in range(6000):
        text = "".join(rnd.choices(PARTS, k=rnd.randint(1, 25)))
        assert private_data.base_spans(text) == brute_base(text), text


def test_spans_of_a_table(spark, field):
    rnd = random.Random(8)
    texts = [None, "", "no data here", "call 007 (055) 555-0199 now", "a" * 5_000, "1" * 5_000, "x@" * 2_000]
    texts += ["".join(rnd.choices((*PARTS, " and ", "the "), k=40)) for _ in range(60)]
    rows = [(i, t, 1, "c") for i, t in enumerate(texts)] + [(3, texts[3], 1, "c"), (None, "m@x.org", 1, "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans int, kind string").repartition(3)
    found = private_data.find(docs, field).collect()
    assert len(found) == len(rows)
    for row in found:
        text = "m@x.org" if row["doc_id"] is None else texts[row["doc_id"]] or ""
        base = [(s["start"], s["end"], s["kind"]) for s in row["spans"] if s["base"]]
        assert base == brute_base(text)
        added = [(s["start"], s["end"]) for s in row["spans"] if not s["base"]]
        assert not any(a < e and s < b for a, b, _ in base for s, e in added)
    assert private_data.find(docs.where("false"), field).count() == 0
    shapes = {c: t for c, t in registered.QUERIES["op12_private_data"](spark, "/root/testdata/sf0.001").dtypes}
    assert shapes["n_email"] == "bigint" and shapes["spans"] == "string"


def test_field_adds_what_patterns_miss(field):
    decoder = private_data.Decoder(field)
    text = "write to hast.22 (at) ering.org or call (055) 555-0199 soon\nnothing 1234 here\ncard 4111/1111/1111/1111 ok"
    found = private_data.spans_of([text], decoder)[0]
    assert [(text[a:b], k, base) for a, b, k, base in found] == [
        ("hast.22 (at) ering.org", "email", False), ("(055) 555-0199", "phone", False), ("4111/1111/1111/1111", "card", False),
    ]


def test_field_on_lines_it_has_not_seen(field):
    decoder, right = private_data.Decoder(field), 0
    lines = private_data.labelled_table(400, seed=77)
    for (text, spans), found in zip(lines, decoder.spans([text for text, _ in lines])):
        right += [(k, a) for a, _, k in found if private_data.plausible(text, (a, _, k))] == [(k, a) for a, _, k in spans]
    assert right >= 390


def test_viterbi_matches_all_paths():
    rng = np.random.default_rng(2)
    kinds = len(private_data.LABELS)
    move = rng.normal(size=(kinds, kinds)) + private_data.allowed_moves()
    lengths = np.array([1, 4, 2, 3])
    score = rng.normal(size=(lengths.sum(), kinds)) * 2
    starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    got = private_data.viterbi(score, move, starts, lengths)
    for start, size in zip(starts, lengths):
        def worth(path):
            steps = zip((0, *path), (*path, 0))
            return sum(move[a, b] for a, b in steps) + sum(score[start + t, label] for t, label in enumerate(path))
        best = max(itertools.product(range(kinds), repeat=int(size)), key=worth)
        assert got[start : start + size].tolist() == list(best)


def test_expectations_are_the_gradient():
    rng = np.random.default_rng(5)
    kinds = len(private_data.LABELS)
    lengths = np.array([3, 1, 2])
    real = np.arange(3)[None] < lengths[:, None]
    score, move = rng.normal(size=(3, 3, kinds)), rng.normal(size=(kinds, kinds))

    def total(score, move):
        out = 0.0
        for i, size in enumerate(lengths):
            paths = itertools.product(range(kinds), repeat=int(size))
            worth = [
                sum(move[a, b] for a, b in zip((0, *p), (*p, 0))) + sum(score[i, t, x] for t, x in enumerate(p)) for p in paths
            ]
            out += np.log(np.exp(worth).sum())
        return out

    marginal, pair = private_data.expectations(score, move, real, lengths)
    for place in [(0, 1, 2), (1, 0, 4), (2, 1, 0)]:
        step = np.zeros_like(score)
        step[place] = 1e-5
        assert abs((total(score + step, move) - total(score - step, move)) / 2e-5 - marginal[place]) < 1e-6
    for place in [(0, 0), (3, 5), (2, 0)]:
        step = np.zeros_like(move)
        step[place] = 1e-5
        assert abs((total(score, move + step) - total(score, move - step)) / 2e-5 - pair[place]) < 1e-6
