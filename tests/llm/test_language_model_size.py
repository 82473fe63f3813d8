"""What the language model hands from task to task stays in proportion to its tokens."""

import numpy as np
import pyarrow as pa

from holdfast.llm import hpylm


def _bytes(batches) -> int:
    return sum(b.nbytes for b in batches)


def test_a_dealt_part_names_its_own_documents_only():
    """Row numbers far apart, more parts: the same tokens, not all documents again for each part."""
    rng = np.random.default_rng(3)
    texts = pa.array([" ".join(f"w{w}" for w in rng.integers(0, 100_000, 20)) for _ in range(2000)])
    rows = pa.array(rng.integers(0, 1 << 60, 2000))
    batch = pa.RecordBatch.from_arrays([rows, pa.array([True] * 2000), texts], ["row_id", "train", "text"])
    few, many = (_bytes(hpylm._deal(hpylm.Model(n, np.zeros(0, np.uint64)))(iter([batch]))) for n in (8, 512))
    assert many < 3 * few


def test_packed_columns_come_back():
    columns = [np.arange(5, dtype=np.uint16), np.array([], np.float64), np.array([-1, 1 << 60]), np.array([True, False])]
    back = hpylm._unpacked(hpylm._packed(*columns), np.uint16, np.float64, np.int64, np.bool_)
    assert all(a.dtype == b.dtype and a.tolist() == b.tolist() for a, b in zip(columns, back, strict=True))
    assert hpylm._unpacked(hpylm._packed(np.array([], np.int64)), np.int64)[0].tolist() == []
