"""Arrays of tokens are numbered some at a time."""

import pyarrow as pa

from vocalake.operators import lengths as L


def test_batches_are_cut_by_tokens():
    rows = [["a"] * 3, None, [], ["b"] * 50, ["c"] * 4, ["d", None], ["e"] * 4]
    batch = pa.record_batch([pa.array(range(7)), pa.array(rows, pa.list_(pa.string()))], ["key", "tokens"])
    out = list(L._by_tokens(iter([batch, batch.slice(0, 0)]), 10))
    assert [b.column("key").to_pylist() for b in out] == [[0, 1, 2], [3], [4, 5, 6]]
    assert [L._numbered_tokens(b.column("tokens"))[0].tolist() for b in out] == [[3, 0, 0], [50], [4, 2, 4]]
