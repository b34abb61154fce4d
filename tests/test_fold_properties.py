"""Property tests of the split fold's building blocks against a brute-force fold."""

from hypothesis import given, settings
from hypothesis import strategies as st

from ordertide.operators.reservation_split import Pieces

ROW = st.one_of(
    st.tuples(st.just("new"), st.integers(0, 60)),
    st.tuples(st.just("release"), st.integers(0, 30)),
    st.tuples(st.just("confirm"), st.integers(0, 30)),
)


def brute(b, rows):
    for kind, a in rows:
        if kind == "new" and a <= b:
            b -= a
        elif kind == "release":
            b += a
    return b


def bound_after(u, rows):
    for kind, a in rows:
        if kind == "new":
            u = max(min(u, a - 1), u - a)
        elif kind == "release":
            u += a
    return max(u, 0)


@settings(max_examples=300, deadline=None)
@given(st.lists(ROW, max_size=60), st.integers(0, 200))
def test_pieces_equal_brute_force(rows, domain):
    p = Pieces(domain)
    for kind, a in rows:
        if kind == "new":
            p.new(a)
        elif kind == "release":
            p.release(a)
    for b in range(domain + 1):
        assert p(b) == brute(b, rows)


@settings(max_examples=300, deadline=None)
@given(st.lists(ROW, max_size=60), st.integers(0, 200), st.integers(0, 200))
def test_interval_bound_is_sound_and_lipschitz(rows, initial, extra):
    g0 = bound_after(initial, rows)
    # sound: every start <= initial ends <= G(initial)
    for b in range(initial + 1):
        assert brute(b, rows) <= g0
    # chain rule used for later partitions: G(B) <= G(initial) + max(0, B - initial)
    big = initial + extra
    assert bound_after(big, rows) <= g0 + extra
    for b in range(big + 1):
        assert brute(b, rows) <= g0 + extra


@settings(max_examples=100, deadline=None)
@given(st.lists(ROW, min_size=1, max_size=80), st.integers(1, 5), st.integers(0, 150))
def test_chunked_composition_equals_one_pass(rows, n_chunks, initial):
    """Folding chunk by chunk through their piece functions gives the one-pass end."""
    size = max(1, len(rows) // n_chunks)
    chunks = [rows[i:i + size] for i in range(0, len(rows), size)]
    b, bound = initial, initial
    for c in chunks:
        p = Pieces(bound)
        for kind, a in c:
            if kind == "new":
                p.new(a)
            elif kind == "release":
                p.release(a)
        assert b <= bound
        b_next = p(b)
        bound = bound_after(initial, c) + max(0, bound - initial)
        b = b_next
    assert b == brute(initial, rows)
