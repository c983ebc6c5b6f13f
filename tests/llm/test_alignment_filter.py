import numpy as np
import pyarrow as pa

from usagelake.llm import chaining


def _texts(rng, n, words):
    return rng.integers(0, words, n).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)


def _lists(rows):
    cut = np.cumsum([0, *map(len, rows)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(cut), pa.array(np.concatenate(rows).view(np.int64)))


def _pairs(rng, n):
    for _ in range(n):
        words = int(rng.choice([30, 300, 1 << 40]))
        a, b = (_texts(rng, int(rng.integers(20, 700)), words) for _ in "ab")
        k = min(int(rng.integers(10, 130)), len(a), len(b))
        i, j = int(rng.integers(0, len(a) - k + 1)), int(rng.integers(0, len(b) - k + 1))
        part, other = a[i:i + k].copy(), rng.random(k) < rng.choice([0, .1, .2, .3])
        part[other] = _texts(rng, int(other.sum()), words)
        b[j:j + k] = part
        yield a, b, i, i + min(4, k), j, j + min(4, k)


def test_the_filter_loses_no_passage_and_drops_unlike_texts():
    rows = list(_pairs(np.random.default_rng(3), 300))
    held = chaining.may_hold(_lists([r[0] for r in rows]), _lists([r[1] for r in rows]))
    found = np.array([bool(chaining.align(*r)[0]) for r in rows])
    assert found.sum() > 50 and (held | ~found).all()
    rng = np.random.default_rng(4)
    unlike = [_texts(rng, 140, 1 << 40) for _ in range(40)]
    assert not chaining.may_hold(_lists(unlike[:20]), _lists(unlike[20:])).any()
    assert not chaining.may_hold(_lists([r[:49] for r in unlike]), _lists([r[:49] for r in unlike])).any()
    empty = _lists([unlike[0][:0], unlike[0][:0]])
    assert not chaining.may_hold(empty, empty).any()


def test_pieces_are_those_of_a_plain_search():
    def plain(x, y):
        other = np.append(0, np.cumsum(np.maximum(np.diff(x), np.diff(y)) - 1))
        out, left = [], [(0, len(x))]
        while left:
            lo, hi = left.pop()
            best, at = -np.inf, None
            for i in range(lo, hi):
                for j in range(i, hi):
                    la, lb, same = x[j] - x[i] + 1, y[j] - y[i] + 1, j - i + 1
                    if min(la, lb) >= chaining.MIN_WORDS and same >= chaining.SIMILARITY * max(la, lb):
                        score = same - 2 * (other[j] - other[i])
                        if score > best:
                            best, at = score, (i, j)
            if at:
                out.append(at)
                left += [(lo, at[0]), (at[1] + 1, hi)]
        return sorted(out)

    rng, some = np.random.default_rng(6), 0
    for _ in range(25):
        x, y = (np.cumsum(rng.choice([1, 2, 30], 180, p=[.93, .06, .01])) for _ in "xy")
        want = plain(x, y)
        some += len(want)
        assert chaining.pieces(x, y) == want
    assert some > 10 and chaining.pieces(np.zeros(0, np.int64), np.zeros(0, np.int64)) == []
