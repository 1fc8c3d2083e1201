"""What a worker and a reader hold at a time."""

import pickle

import numpy as np
import pyarrow as pa

from orefold.llm import common
from orefold.llm.common import binary, powers, with_workers
from orefold.llm.decontaminate import MAX_EDITS, TARGET_RECALL, Items, symbols


def test_powers_are_made_as_far_as_needed():
    common.at_rest()
    up, down = powers(1_000)
    assert 1_000 <= len(up) == len(down) <= 256 * 1024
    base = int(common._POWER_BASE)
    assert [int(x) for x in up[:5]] == [pow(base, k, 1 << 64) for k in range(5)]
    assert (up * down == np.uint64(1)).all()
    more, _ = powers(len(up) + 1)
    assert len(more) > len(up) and (more[: len(up)] == up).all()
    common.at_rest()


def test_few_items_travel_as_few_bytes():
    text = "what is the largest lake of the northern plains and which river leaves it to the sea"
    items = Items([7], [text], MAX_EDITS, TARGET_RECALL)
    assert len(pickle.dumps(items)) < 500_000
    found = items.matches(*symbols(binary(pa.array(["first " + text + " last", "nothing of it"]))))
    assert [m[:2] + m[4:] for m in found] == [(0, 0, 0)]


def test_readers_and_workers_get_bounded_batches(spark):
    keys = "spark.sql.parquet.columnarReaderBatchSize", "spark.sql.execution.arrow.maxBytesPerBatch"
    rows, size = with_workers(lambda s: [int(s.conf.get(k)) for k in keys], 1 << 20)(spark)
    assert rows <= 1024 and size == 1 << 20
    rows, size = with_workers(lambda s: [int(s.conf.get(k)) for k in keys])(spark)
    assert rows <= 1024 and size == common.BATCH_BYTES
