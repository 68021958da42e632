import pytest

from panelcast.operators.splits import expanding_splits, inner_splits, rolling_splits


def test_expanding_split_arithmetic():
    s = expanding_splits(259, 2)
    assert [len(tr) for tr, _ in s] == [87, 173]
    assert [len(va) for _, va in s] == [86, 86]


def test_rolling_splits_drop_short_fold():
    weeks = list(range(259))
    out = rolling_splits(weeks, 2, 104)
    assert len(out) == 1
    tr, va = out[0]
    assert len(tr) == 173 and len(va) == 86


def test_rolling_splits_errors_and_fallbacks():
    with pytest.raises(RuntimeError):
        rolling_splits(list(range(11)), 2, 52)
    one = rolling_splits(list(range(20)), 1, 52)
    assert len(one[0][0]) == 16 and len(one[0][1]) == 4
    # 40 weeks < 52 + 2: folds shrink to max(2, min(3, 40 // 26)) = 2, min train 52 -> none -> 80/20 cut
    fb = rolling_splits(list(range(40)), 2, 52)
    assert len(fb) == 1 and len(fb[0][0]) == 32


def test_inner_splits():
    assert inner_splits(list(range(3)), 3) == []
    out = inner_splits(list(range(200)), 3, 52)
    assert all(len(tr) >= 52 for tr, _ in out)
