"""A small causal self-attention model over subword ids, trained and applied in numpy."""

from __future__ import annotations

import numpy as np

GROUPS = 32
MEMBERS = 32
CLASSES = GROUPS * MEMBERS
OFTEN = 2
WIDTH = 16
BATCH = 512
WINDOW = 32
SCORED = 24
BACK = WINDOW - SCORED
SEEDS = 32
# Windows attended to at once, and places classed at once, so that what a step works on stays in the processor's cache.
PIECE, PLACES = 128, 4096
LOWEST = np.float32(-1e9)
LARGEST, LEAST_SUM = 60, np.float32(1e-20)


def token_classes(ids: np.ndarray, opening: np.ndarray, rounds: int = 12, seed: int = 7):
    """``(class of each id, features, middles of classes)``: ids gathered by what stands before and after them.

    Classes come in ``GROUPS`` of ``MEMBERS``. ``opening`` says which ids open a word; the upper half of the groups is for these,
    the lower half for the others. Of each half the first class takes the ids that the sample lacks; the class after it is
    that of the end of a text in the upper half. The next ``OFTEN`` groups give each of the most frequent ids a class of its
    own, which has no middle; the others are parted twice, into groups and then into classes. The last id is the end.
    Neighbours are summed as random sign vectors, so an id's features need no table of pairs.
    """
    rng, vocabulary, half = np.random.default_rng(seed), len(opening), CLASSES // 2
    counts = np.bincount(ids, minlength=vocabulary).astype(np.float64)
    features = neighbour_sums(ids, np.arange(vocabulary), counts)
    features /= np.linalg.norm(features, axis=1, keepdims=True) + 1e-6
    out, middles = np.where(opening, half, 0), np.full((CLASSES, 2 * SEEDS), np.inf, np.float32)
    for first, kind in ((0, ~opening), (half, opening)):
        kind = kind.copy()
        kind[-1] = False
        seen = np.flatnonzero((counts > 0) & kind)
        seen = seen[np.argsort(-counts[seen], kind="stable")]
        often, rest = seen[:OFTEN * MEMBERS], seen[OFTEN * MEMBERS:]
        out[often] = first + MEMBERS + np.arange(len(often))
        group, _ = _parted(features, np.sqrt(counts), rest, GROUPS // 2 - 1 - OFTEN, rounds, rng)
        for g in range(int(group.max(initial=-1)) + 1):
            own = rest[group == g]
            at = first + (1 + OFTEN + g) * MEMBERS
            member, middle = _parted(features, np.sqrt(counts), own, MEMBERS, rounds, rng)
            out[own], middles[at:at + len(middle)] = at + member, middle
    out[-1] = half + 1
    return out, features, middles


def _parted(features: np.ndarray, weight: np.ndarray, ids: np.ndarray, most: int, rounds: int, rng) -> tuple[np.ndarray, np.ndarray]:
    """The number of the nearest of at most ``most`` middles for each of the ids, and the middles."""
    k = min(most, len(ids))
    if not k:
        return np.empty(0, np.int64), np.empty((0, features.shape[1]), np.float32)
    own, weight = features[ids], weight[ids]
    middle = own[rng.choice(len(ids), k, replace=False, p=weight / weight.sum())]
    for _ in range(rounds):
        near = np.argmax(own @ middle.T - 0.5 * (middle ** 2).sum(axis=1), axis=1)
        total = np.bincount(near, weight, k)[:, None] + 1e-9
        middle = np.column_stack([np.bincount(near, weight * own[:, j], k) for j in range(own.shape[1])]) / total
        middle = middle.astype(np.float32)
    return near, middle


def neighbour_sums(ids: np.ndarray, wanted: np.ndarray, counts: np.ndarray, seed: int = 5) -> np.ndarray:
    """For each of the ``wanted`` ids (sorted) the sum of the sign vectors of the ids before it and of those after it; an id
    of many ``counts`` weighs less."""
    signs = np.random.default_rng(seed).choice(np.array([-1.0, 1.0], np.float32), (len(counts), SEEDS))
    signs *= (1 / np.sqrt(counts + 1)).astype(np.float32)[:, None]
    number, asked = np.zeros(len(counts), np.int64), np.zeros(len(counts), bool)
    number[wanted], asked[wanted] = np.arange(len(wanted)), True
    place = np.flatnonzero(asked[ids])
    out = np.empty((len(wanted), 2 * SEEDS), np.float32)
    for at, here, other in ((0, place[place < len(ids) - 1], 1), (SEEDS, place[place > 0], -1)):
        own, other = number[ids[here]], ids[here + other]
        for k in range(SEEDS):
            out[:, at + k] = np.bincount(own, signs[other, k], len(wanted))
    return out


def late_classes(features: np.ndarray, opening: np.ndarray, middles: np.ndarray) -> np.ndarray:
    """The class of ids that the sample lacks, from the sums of their neighbours in all texts."""
    features = features / (np.linalg.norm(features, axis=1, keepdims=True) + 1e-6)
    half, known = len(middles) // 2, np.isfinite(middles).all(axis=1)
    near = features @ np.where(known[:, None], middles, 0).T - 0.5 * np.where(known, (np.where(known[:, None], middles, 0) ** 2).sum(axis=1), np.inf)
    near[:, 0], near[:, half] = -1e6, -1e6  # taken where a half has no middles
    return np.where(opening, half + np.argmax(near[:, half:], axis=1), np.argmax(near[:, :half], axis=1))


def windows_of(bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows over texts that begin at ``bounds``: for each, its text and the first place it scores, and how many.

    A text of n ids has n places to score. Each window scores ``SCORED`` of them and sees ``WINDOW - SCORED`` places before
    the first, so windows overlap and every place is scored once.
    """
    lengths = np.diff(bounds)
    n = -(-lengths // SCORED)
    owner = np.repeat(np.arange(len(lengths)), n)
    first = (np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)) * SCORED
    return owner, first, np.minimum(SCORED, lengths[owner] - first)


class Windows:
    """What each window reads and asks for. What is read at a place is the id before it; the first place of a text, and all before
    it, read the end id."""

    def __init__(self, ids: np.ndarray, bounds: np.ndarray, classes: np.ndarray):
        """What is asked for at a place is the class of its id."""
        owner, self.first, self.n = windows_of(bounds)
        self.start, self.end, n = bounds[owner] + self.first, len(classes) - 1, len(ids)
        read, asked, classes = np.full(BACK + n + WINDOW, self.end, np.int32), np.zeros(n + SCORED, np.int16), classes.astype(np.int16)
        read[BACK + 1:BACK + n] = ids[:-1]
        read[BACK + bounds[:-1]] = self.end
        # What lies past the last place is read by none of those that are scored.
        read[BACK + n:] = read[BACK + n - 1]
        for a in range(0, n, 500_000):
            asked[a:min(a + 500_000, n)] = classes[ids[a:a + 500_000]]
        self.read = np.lib.stride_tricks.sliding_window_view(read, WINDOW)
        self.asked = np.lib.stride_tricks.sliding_window_view(asked, SCORED)

    def __len__(self) -> int:
        return len(self.start)

    def __getitem__(self, pick) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Read ids of some windows, the numbers of the places scored in them, and what is asked for there."""
        start = self.start[pick]
        seen = self.read[start].astype(np.int64)
        seen[self.first[pick] == 0, :BACK] = self.end
        real = np.flatnonzero(np.arange(SCORED) < self.n[pick][:, None])
        return seen, real, self.asked[start].ravel()[real].astype(np.int64)


def by_group(group: np.ndarray) -> tuple[np.ndarray, list[list[tuple[int, int, int]]]]:
    """Order of places by the group of what they ask for, and ``(group, from, to)`` of each stretch of the order, in lists of
    stretches of about ``PLACES`` places."""
    order = np.argsort(group.astype(np.uint8), kind="stable")
    edges = np.concatenate(([0], np.cumsum(np.bincount(group, minlength=GROUPS))))
    lists = [[]]
    for g in np.flatnonzero(np.diff(edges)).tolist():
        lists[-1].append((g, int(edges[g]), int(edges[g + 1])))
        if lists[-1][-1][2] - lists[-1][0][1] >= PLACES:
            lists.append([])
    return order, [stretches for stretches in lists if stretches]


def exp_rows(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray | float]:
    """``(exp, sums of rows, what was taken from each row before)``: the largest of a row is taken off only where exp or its sum
    would leave the range, which few batches need."""
    def sums(out: np.ndarray) -> np.ndarray:
        return (out.reshape(-1, out.shape[-1]) @ np.ones(out.shape[-1], np.float32)).reshape(out.shape[:-1])

    if not values.size or values.max() < LARGEST:
        out = np.exp(values)
        total = sums(out)
        if not total.size or total.min() > LEAST_SUM:
            return out, total, 0.0
    top = values.max(axis=-1)
    out = np.exp(values - top[..., None])
    return out, sums(out), top


def distances(near: np.ndarray) -> np.ndarray:
    """What each place of a window adds to the scores of the places it sees, by their distance; none of those after it."""
    row, column = np.arange(BACK, WINDOW)[:, None], np.arange(WINDOW)[None, :]
    return np.where(column <= row, near[np.clip(row - column, 0, WINDOW - 1)], LOWEST).astype(np.float32)


def asking(w: dict[str, np.ndarray]) -> np.ndarray:
    """One layer that gives the query of a vector, turned by the keys' layer so that it meets vectors themselves."""
    return (w["query"] / np.float32(np.sqrt(WIDTH))) @ w["key"].T


def attend(part: np.ndarray, turned: np.ndarray, bias: np.ndarray, both: np.ndarray) -> np.ndarray:
    """Shares of the places seen; into ``both`` go each scored place's own vector, the mean of the vectors it sees by these
    shares, and a one. ``part`` holds for each place of the windows its vector and query, ``turned`` the vectors by column."""
    score = part[:, BACK:, WIDTH:2 * WIDTH] @ turned
    score += bias
    share, total, _ = exp_rows(score)
    share *= (1 / total)[:, :, None]
    both = both.reshape(len(part), SCORED, -1)
    both[:, :, :WIDTH], both[:, :, -1] = part[:, BACK:, :WIDTH], 1
    np.matmul(share, part[:, :, :WIDTH], out=both[:, :, WIDTH:-1])
    return share


def output_layers(w: dict[str, np.ndarray]) -> np.ndarray:
    """For each group one layer that gives the logits of all groups and then those of its own classes; offsets come last."""
    out = np.empty((GROUPS, 2 * WIDTH + 1, GROUPS + MEMBERS), np.float32)
    out[:, :-1, :GROUPS], out[:, -1, :GROUPS] = w["top"], w["top_offset"]
    out[:, :-1, GROUPS:], out[:, -1, GROUPS:] = w["member"], w["member_offset"]
    return out


def valued(out: np.ndarray, value: np.ndarray) -> np.ndarray:
    """The same for means of vectors: the layer of values comes before each, so that no place needs it of its own."""
    out = out.copy()
    out[:, WIDTH:-1] = value @ out[:, WIDTH:-1]
    return out


def logits_of(out: np.ndarray, both: np.ndarray, stretches: list[tuple[int, int, int]]) -> np.ndarray:
    """Logits of groups and of the classes of the asked group, for places in the order of groups."""
    start = stretches[0][1]
    logits = np.empty((len(both), GROUPS + MEMBERS), np.float32)
    for g, a, b in stretches:
        np.matmul(both[a - start:b - start], out[g], out=logits[a - start:b - start])
    return logits


class AttentionModel:
    """Next-id probabilities: one attention head over the window gives the chance of the next id's group of classes, and of
    its class in the group; within a class ids follow corpus counts. Every text starts and is padded on the left with its end
    id, and ends with it. Classes that hold no id get no chance, so the chances of all ids sum to one."""

    def __init__(self, classes: np.ndarray, weights: dict[str, np.ndarray], log_within: np.ndarray):
        self.classes, self.log_within = classes, log_within.astype(np.float32)
        w = {k: v.astype(np.float32) for k, v in weights.items()}
        self.table = np.concatenate([w["token"], w["token"] @ asking(w)], axis=1)
        held = np.bincount(classes, minlength=CLASSES).reshape(GROUPS, MEMBERS) > 0
        w["member_offset"] = np.where(held, w["member_offset"], LOWEST)
        w["top_offset"] = np.where(held.any(axis=1), w["top_offset"], LOWEST)
        self.out, self.bias = valued(output_layers(w), w["value"]), distances(w["near"])

    def log_probabilities(self, ids: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """For each id of texts that lie between ``bounds`` (end id last): the log probability of the id after those before
        it."""
        gained = np.empty(len(ids), np.float32)
        windows = Windows(ids, bounds, self.classes)
        for a in range(0, len(windows), BATCH):
            seen, real, target = windows[np.arange(a, min(a + BATCH, len(windows)))]
            both = np.empty((len(seen) * SCORED, 2 * WIDTH + 1), np.float32)
            for b in range(0, len(seen), PIECE):
                part = self.table.take(seen[b:b + PIECE], axis=0)
                turned = np.ascontiguousarray(part[:, :, :WIDTH].transpose(0, 2, 1))
                attend(part, turned, self.bias, both[b * SCORED:(b + PIECE) * SCORED])
            group, member = np.divmod(target, MEMBERS)
            order, lists = by_group(group)
            # Windows follow each other, and each scores the places after those of the one before.
            first = windows.start[a]
            own = np.empty(len(real), np.float32)
            for stretches in lists:
                at = order[stretches[0][1]:stretches[-1][2]]
                logits = logits_of(self.out, both.take(real[at], axis=0), stretches).reshape(-1, 2, MEMBERS)
                _, total, less = exp_rows(logits)
                each, flat = np.arange(len(at)) * (GROUPS + MEMBERS), logits.reshape(-1)
                less = np.log(total) + less
                own[at] = flat[each + group[at]] + flat[each + (GROUPS + member[at])] - less[:, 0] - less[:, 1]
            gained[first:first + len(real)] = own + self.log_within[ids[first:first + len(real)]]
        return gained


def log_within(classes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Log probability of each id within its class, from corpus counts plus one."""
    each = counts.astype(np.float64) + 1
    return np.log(each) - np.log(np.maximum(np.bincount(classes, each, CLASSES), 1))[classes]


def train(ids: np.ndarray, bounds: np.ndarray, opening: np.ndarray, steps: int = 300, batch: int = 256,
          rate: float = 0.01, seed: int = 11) -> tuple[np.ndarray, dict[str, np.ndarray], np.ndarray]:
    """Classes of ids, the weights that predict the next id's class, by Adam over random windows of a sample of texts, and
    the middles of the classes."""
    classes, features, middles = token_classes(ids, opening)
    rng = np.random.default_rng(seed)
    spread = rng.normal(0, 1, (features.shape[1], WIDTH)) / np.sqrt(features.shape[1])
    w = {"token": features @ spread * 2, "near": np.zeros(WINDOW), "top_offset": np.zeros(GROUPS),
         "top": rng.normal(0, 0.1, (2 * WIDTH, GROUPS)), "member_offset": np.zeros((GROUPS, MEMBERS)),
         "member": rng.normal(0, 0.1, (GROUPS, 2 * WIDTH, MEMBERS))}
    w |= {k: rng.normal(0, 1 / np.sqrt(WIDTH), (WIDTH, WIDTH)) for k in ("query", "key", "value")}
    w = {k: v.astype(np.float32) for k, v in w.items()}
    windows = len(windows_of(bounds)[0])
    picks = [rng.integers(0, windows, batch) for _ in range(steps)] if windows else []
    return classes, learn(w, classes, ids, bounds, picks, rate), middles


def learn_all(w: dict[str, np.ndarray], classes: np.ndarray, ids: np.ndarray, bounds: np.ndarray, seed: int,
              rate: float = 0.003) -> tuple[int, dict[str, np.ndarray]]:
    """The windows of these texts, and the weights after each of them has been learnt from once."""
    order = np.random.default_rng(seed).permutation(len(windows_of(bounds)[0]))
    return len(order), learn(w, classes, ids, bounds, [order[a:a + BATCH] for a in range(0, len(order), BATCH)], rate)


def output_slopes(out: np.ndarray, both: np.ndarray, real: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slopes of the mean loss by the output layers and by what they are given, of which the last column is left free."""
    group, member = np.divmod(target, MEMBERS)
    order, lists = by_group(group)
    back, one = np.ascontiguousarray(out[:, :-1].transpose(0, 2, 1)), np.float32(1 / max(len(real), 1))
    # The last row is that of all places that are not scored.
    d_out, d_given, place = np.zeros_like(out), np.zeros((len(real) + 1, both.shape[1]), np.float32), np.full(len(both), len(real))
    place[real[order]] = np.arange(len(real))
    for stretches in lists:
        start, end = stretches[0][1], stretches[-1][2]
        at = order[start:end]
        given = both.take(real[at], axis=0)
        p, total, _ = exp_rows(logits_of(out, given, stretches).reshape(-1, 2, MEMBERS))
        p *= (one / total)[:, :, None]
        p = p.reshape(len(at), -1)
        each, flat = np.arange(len(at)) * p.shape[1], p.reshape(-1)
        np.subtract.at(flat, each + group[at], one)
        np.subtract.at(flat, each + (GROUPS + member[at]), one)
        for g, a, b in stretches:
            np.matmul(given[a - start:b - start].T, p[a - start:b - start], out=d_out[g])
            np.matmul(p[a - start:b - start], back[g], out=d_given[a:b, :-1])
    return d_out, d_given.take(place, axis=0)


def slopes(w: dict[str, np.ndarray], seen: np.ndarray, real: np.ndarray, target: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """Slopes of the mean loss by each weight, for windows of read ids, the numbers of the places scored in them and the
    classes asked for there; for ``token`` by the rows that are read, which come second.

    Queries are made once for each id of the batch. What a piece of the batch needs on the way back is kept from the way there.
    """
    size = seen.size
    bits = size.bit_length()
    key = np.sort((seen.ravel() << bits) + np.arange(size))
    ids = key >> bits
    order, new = key & ((1 << bits) - 1), np.concatenate(([True], ids[1:] != ids[:-1]))
    starts, number = np.flatnonzero(new), np.empty(size, np.int64)
    number[order] = np.cumsum(new) - 1
    rows = ids[starts]
    own, ask, bias, out = w["token"].take(rows, axis=0), asking(w), distances(w["near"]), output_layers(w)
    table, number = np.concatenate([own, own @ ask], axis=1), number.reshape(seen.shape)
    kept, both = [], np.empty((len(seen) * SCORED, 2 * WIDTH + 1), np.float32)
    for a in range(0, len(seen), PIECE):
        part = table.take(number[a:a + PIECE], axis=0)
        turned = np.empty((len(part), WIDTH + 1, WINDOW), np.float32)
        turned[:, :-1], turned[:, -1] = part[:, :, :WIDTH].transpose(0, 2, 1), -1  # takes from a score's slope the mean of its row
        kept.append((part, turned, attend(part, turned[:, :-1], bias, both[a * SCORED:(a + PIECE) * SCORED])))
    d_out, d_both = output_slopes(valued(out, w["value"]), both, real, target)
    d_ask, d_near, d_x = np.zeros_like(ask), np.zeros(SCORED * WINDOW, np.float32), np.empty((*seen.shape, WIDTH), np.float32)
    through = np.concatenate([np.eye(WIDTH, dtype=np.float32), ask.T])
    for a, (part, turned, share) in zip(range(0, len(seen), PIECE), kept):
        m, at = len(part), slice(a * SCORED, (a + PIECE) * SCORED)
        mean, d = both[at].reshape(m, SCORED, -1)[:, :, WIDTH:-1], d_both[at].reshape(m, SCORED, -1)
        d_mean = d[:, :, WIDTH:-1]
        np.einsum("bsw,bsw->bs", d_mean, mean, out=d[:, :, -1])
        d_score = d[:, :, WIDTH:] @ turned
        d_score *= share
        d_near += np.ones(m, np.float32) @ d_score.reshape(m, -1)
        np.matmul(share.transpose(0, 2, 1), d_mean, out=d_x[a:a + PIECE])
        d_x[a:a + PIECE] += d_score.transpose(0, 2, 1) @ part[:, BACK:, WIDTH:]
        d_query = np.matmul(d_score, part[:, :, :WIDTH], out=d_mean)
        d_ask += (part[:, BACK:, :WIDTH].transpose(0, 2, 1) @ d_query).sum(axis=0)
        d_x[a:a + PIECE, BACK:] += (d.reshape(m * SCORED, -1)[:, :-1] @ through).reshape(m, SCORED, WIDTH)
    back, scale = np.clip(np.arange(BACK, WINDOW)[:, None] - np.arange(WINDOW), 0, WINDOW - 1), np.float32(1 / np.sqrt(WIDTH))
    d_value = np.tensordot(d_out[:, WIDTH:-1], out[:, WIDTH:-1], ((0, 2), (0, 2)))
    d_out[:, WIDTH:-1] = w["value"].T @ d_out[:, WIDTH:-1]
    top = d_out[:, :, :GROUPS].sum(axis=0)
    return {"top": top[:-1], "top_offset": top[-1], "member": d_out[:, :-1, GROUPS:], "member_offset": d_out[:, -1, GROUPS:],
            "near": np.bincount(back.ravel(), d_near, WINDOW), "query": d_ask @ w["key"] * scale, "key": d_ask.T @ w["query"] * scale,
            "value": d_value, "token": np.add.reduceat(d_x.reshape(-1, WIDTH).take(order, axis=0), starts, axis=0)}, rows


def learn(w: dict[str, np.ndarray], classes: np.ndarray, ids: np.ndarray, bounds: np.ndarray, picks: list[np.ndarray],
          rate: float) -> dict[str, np.ndarray]:
    """The weights after a step of Adam for each of ``picks``, numbers of windows. A step moves the rows of ids it reads and
    no others."""
    if not len(ids):
        return w
    # All weights but those of ids lie in one array, so that a step moves them at once.
    dense = [k for k in w if k != "token"]
    edges = np.cumsum([0] + [w[k].size for k in dense])
    flat = np.concatenate([w[k].ravel() for k in dense]).astype(np.float32)
    w = {"token": w["token"].astype(np.float32)} | {k: flat[a:b].reshape(w[k].shape) for k, a, b in zip(dense, edges, edges[1:])}
    moved = {"token": w["token"], "dense": flat}
    mean, square = ({k: np.zeros_like(v) for k, v in moved.items()} for _ in range(2))
    windows, steps = Windows(ids, bounds, classes), len(picks)
    for step, pick in enumerate(picks, 1):
        slope, rows = slopes(w, *windows[pick])
        pace = np.float32(rate * (1 - 0.9 * step / steps) / (1 - 0.9 ** step))
        even = np.float32(1 / (1 - 0.99 ** step))
        for name, at, g in (("token", rows, slope["token"]),
                            ("dense", ..., np.concatenate([slope[k].ravel() for k in dense]).astype(np.float32))):
            m, s = 0.9 * mean[name][at] + 0.1 * g, 0.99 * square[name][at] + 0.01 * g * g
            mean[name][at], square[name][at] = m, s
            moved[name][at] -= pace * m / (np.sqrt(s * even) + np.float32(1e-8))
    return w
