"""The attention model against a loop over single ids, and its slopes against differences."""

import numpy as np
import pytest

from statline.llm import attention as A


@pytest.fixture(scope="module")
def model():
    """A small vocabulary of 90 ids, of which the upper half opens words and the last is the end."""
    rng = np.random.default_rng(3)
    texts = [rng.integers(0, 80, n) for n in (0, 1, 5, 24, 25, 60, 200)]
    ids = np.concatenate([np.append(t, 90) for t in texts])
    bounds = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts])))
    classes, weights, _ = A.train(ids, bounds, np.arange(91) >= 45, steps=20, batch=8)
    return ids, bounds, classes, weights, A.log_within(classes, np.bincount(ids, minlength=91))


def single(classes, w, within, before, target):
    """Log probability of one id after those before it in its window, in doubles, one id at a time."""
    w = {k: v.astype(np.float64) for k, v in w.items()}
    x = w["token"][before]
    query = x[-1] @ w["query"] / np.sqrt(A.WIDTH)
    score = np.array([query @ (x[i] @ w["key"]) + w["near"][len(x) - 1 - i] for i in range(len(x))])
    share = np.exp(score - score.max())
    share /= share.sum()
    both = np.concatenate([x[-1], sum(s * (v @ w["value"]) for s, v in zip(share, x))])
    held = np.bincount(classes, minlength=A.CLASSES).reshape(A.GROUPS, A.MEMBERS) > 0
    group, member = divmod(int(classes[target]), A.MEMBERS)
    total = within[target]
    for logits, own, real in ((both @ w["top"] + w["top_offset"], group, held.any(axis=1)),
                              (both @ w["member"][group] + w["member_offset"][group], member, held[group])):
        total += logits[own] - logits[real].max() - np.log(np.exp(logits[real] - logits[real].max()).sum())
    return total


@pytest.mark.parametrize("scale", [1, 100])
def test_every_id_as_if_scored_alone(model, scale):
    """Also where scores leave the range of exp."""
    ids, bounds, classes, weights, within = model
    weights = weights | {k: weights[k] * np.float32(scale) for k in ("query", "top", "member")}
    got = A.AttentionModel(classes, weights, within).log_probabilities(ids, bounds)
    assert scale == 1 or got.min() < -100
    for start, stop in zip(bounds[:-1], bounds[1:]):
        read = np.concatenate(([90] * A.WINDOW, ids[start:stop - 1]))
        for i in range(stop - start):
            # A place sees all from the first place of its window on.
            seen = i % A.SCORED + A.WINDOW - A.SCORED + 1
            before = read[A.WINDOW + i - seen:A.WINDOW + i]
            assert got[start + i] == pytest.approx(single(classes, weights, within, before, ids[start + i]), rel=1e-3, abs=1e-3)


def test_chances_of_all_ids_sum_to_one(model):
    _, _, classes, weights, within = model
    rng = np.random.default_rng(5)
    for n in (0, 3, 30):
        before = rng.integers(0, 80, n)
        texts = np.concatenate([np.append(before, c) for c in range(91)])
        gained = A.AttentionModel(classes, weights, within).log_probabilities(texts, np.arange(92) * (n + 1))
        assert np.exp(gained[n::n + 1].astype(np.float64)).sum() == pytest.approx(1, abs=1e-3)


def test_slopes_are_those_of_the_loss(model):
    ids, bounds, classes, weights, _ = model
    owner, first, n = A.windows_of(bounds)
    read = np.concatenate(([90], ids[:-1]))
    read[bounds[:-1]] = 90
    place = bounds[owner][:, None] + first[:, None] + np.arange(A.WINDOW) - (A.WINDOW - A.SCORED)
    seen = np.where(place >= bounds[owner][:, None], read[np.clip(place, 0, len(read) - 1)], 90)
    real = np.flatnonzero((np.arange(A.SCORED) < n[:, None]).ravel())
    target = classes[ids[place[:, A.WINDOW - A.SCORED:].ravel()[real]]]

    def loss(w):
        total = 0.0
        for at, c in zip(real, target):
            row, i = divmod(int(at), A.SCORED)
            x = w["token"][seen[row, :A.WINDOW - A.SCORED + i + 1]].astype(np.float64)
            score = (x[-1] @ w["query"]) @ (x @ w["key"]).T / np.sqrt(A.WIDTH) + w["near"][np.arange(len(x))[::-1]]
            share = np.exp(score - score.max())
            both = np.concatenate([x[-1], share / share.sum() @ (x @ w["value"])])
            group, member = divmod(int(c), A.MEMBERS)
            for logits, own in ((both @ w["top"] + w["top_offset"], group),
                                (both @ w["member"][group] + w["member_offset"][group], member)):
                total -= logits[own] - np.log(np.exp(logits).sum())
        return total / len(target)

    slope, rows = A.slopes(weights, seen, real, target)
    rng, precise = np.random.default_rng(9), {k: v.astype(np.float64) for k, v in weights.items()}
    whole = np.zeros_like(precise["token"])
    whole[rows] = slope["token"]
    for name, g in (slope | {"token": whole}).items():
        for at in sorted({tuple(rng.integers(0, precise[name].shape)) for _ in range(4)} | {np.unravel_index(np.abs(g).argmax(), g.shape)}):
            up, down = ({**precise, name: precise[name].copy()} for _ in range(2))
            up[name][at] += 1e-4
            down[name][at] -= 1e-4
            assert g[at] == pytest.approx((loss(up) - loss(down)) / 2e-4, abs=2e-4), (name, at)


def test_learning_lowers_the_loss_and_leaves_other_rows(model):
    ids, bounds, classes, weights, within = model
    n, learnt = A.learn_all(weights, classes, ids, bounds, 1)
    assert n == len(A.windows_of(bounds)[0])
    gain = [A.AttentionModel(classes, w, within).log_probabilities(ids, bounds).sum() for w in (weights, learnt)]
    assert gain[1] > gain[0]
    unread = np.setdiff1d(np.arange(90), ids)
    assert len(unread) and (learnt["token"][unread] == weights["token"][unread]).all()
    assert A.learn_all(weights, classes, ids[:0], np.array([0]), 1)[0] == 0
