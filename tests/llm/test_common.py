import os

import numpy as np
import pyarrow as pa
import pytest

from tessera.llm import common, hashing


def test_written_tables_are_kept_until_dropped(spark):
    rows = common.written(spark.range(5), "numbers")
    assert rows.count() == 5
    folder = common._own_folder(spark).removeprefix("file:").replace("//", "/")
    assert any(n.startswith("numbers-") for n in os.listdir(folder))
    common.drop_written(spark)
    assert not os.path.exists(folder)


@pytest.mark.parametrize("kind", [pa.string(), pa.large_string()])
def test_bytes_of_sliced_columns_with_nulls(kind):
    column = pa.array(["skip", "aé", None, "", "b"], kind).slice(1)
    data, offsets = common.utf8(column)
    assert data.tobytes() == "aéb".encode() and offsets.tolist() == [0, 3, 3, 3, 4]
    data, offsets = common.utf8(pa.array([None, None], kind))
    assert len(data) == 0 and offsets.tolist() == [0, 0, 0]


def test_words_do_not_cross_documents():
    texts = [b"one two", b"", b"three", b"  ", b"one  two"]
    data = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    found, at = hashing.words(data, offsets)
    assert at.tolist() == [0, 2, 2, 3, 3, 5]
    assert found[:2].tolist() == found[3:].tolist() and len(set(found[:3].tolist())) == 3
    assert hashing.grams(found, 6).tolist() == [] and hashing.grams(found[:2], 2) == hashing.grams(found[3:], 2)
    assert hashing.grams(found[:2], 2)[0] != hashing.grams(found[:2][::-1], 2)[0]
