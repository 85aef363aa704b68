"""The replay helper against a plain dictionary book, over random updates and batch cuts."""

import pyarrow as pa
from hypothesis import given, settings, strategies as st

from tickloom.operators.replay import EMIT, SILENT, replay

updates = st.lists(
    st.tuples(
        st.booleans(),  # starts a new group
        st.sampled_from([1, -1, 0]),
        st.integers(1, 8).map(float),
        st.sampled_from([0.0, 1e-10, 1.0, 2.5, 7.0]),
        st.sampled_from([EMIT, EMIT, SILENT]),
    ),
    min_size=1, max_size=60,
)


def _plain(rows, depth):
    out, book = [], {1: {}, -1: {}}
    for i, (starts, write, price, quantity, role) in enumerate(rows):
        if starts:
            book = {1: {}, -1: {}}
        if write and quantity < 1e-9:
            book[write].pop(price, None)
        elif write:
            book[write][price] = quantity
        if role == EMIT:
            levels = []
            for sign in (1, -1):
                ordered = sorted(book[sign].items(), key=lambda x: sign * x[0])[:depth]
                levels += [{"ask": sign > 0, "level": n, "price": p, "quantity": v} for n, (p, v) in enumerate(ordered)]
            out.append((i, levels))
    return out


@settings(max_examples=150, deadline=None)
@given(rows=updates, depth=st.sampled_from([1, 3, None]), size=st.integers(1, 20))
def test_replay(rows, depth, size):
    columns = list(zip(*rows))
    table = pa.RecordBatch.from_arrays(
        [pa.array(columns[0]), pa.array(columns[1], pa.int32()), pa.array(columns[2]), pa.array(columns[3]),
         pa.array(columns[4], pa.int32()), pa.array(range(len(rows)), pa.int64())],
        names=["_starts", "_write", "price", "quantity", "_role", "_pos"],
    )
    cuts = [table.slice(i, size) for i in range(0, len(rows), size)]
    got = [(r["pos"], r["book"]) for batch in replay(depth, [])(iter(cuts)) for r in batch.to_pylist()]
    assert got == _plain(rows, depth)
