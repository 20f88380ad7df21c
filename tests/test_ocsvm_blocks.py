"""Mapped rows as stored blocks: every row comes back, in any cut."""

import numpy as np
import pyarrow as pa

from dayguard.operators import ocsvm_dual as O


def test_blocks_hold_all_rows():
    z = np.random.default_rng(3).normal(size=(2500, 7))
    parts = [z[s:s + O.BLOCK].tobytes() for s in range(0, len(z), O.BLOCK)]
    batches = [O._batch(z=(parts[:1], pa.binary())), O._batch(z=(parts[1:], pa.binary())), O._batch(z=([], pa.binary()))]
    assert np.array_equal(np.concatenate(list(O._blocks(batches, 7))), z)


def test_rows_of_a_list_column_and_of_a_slice():
    x = np.arange(12.0).reshape(4, 3)
    column = pa.array(x.tolist(), pa.list_(pa.float64()))
    assert np.array_equal(O._rows(column, 3), x) and np.array_equal(O._rows(column.slice(1, 2), 3), x[1:3])
