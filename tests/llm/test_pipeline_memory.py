import pyarrow as pa
import pytest

import corpus_pipeline
from lakeward.session import ARROW_BATCH

NAME, MOST = ARROW_BATCH
TEXT = 1 << 16


@pytest.fixture
def unset(spark):
    before = spark.conf.get(NAME, None)
    spark.conf.unset(NAME)
    yield
    spark.conf.unset(NAME)
    if before is not None:
        spark.conf.set(NAME, before)


def _largest(df) -> int:
    """Bytes of the largest batch that a worker gets of ``df``."""
    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"n": pa.array([b.nbytes], pa.int64())})
    return max(r["n"] for r in df.mapInArrow(sizes, "n long").collect())


def test_stages_hand_whole_texts_over_in_small_batches(spark, docs, unset):
    rows = docs([f"{i} " + "word " * (TEXT // 5) for i in range(200)]).coalesce(1).select("doc_id", "text")
    assert _largest(rows) > 12 << 20
    corpus_pipeline.encode(spark, docs(["a text"]), "")
    assert _largest(rows) < (4 << 20) + 2 * TEXT
    assert rows.count() == 200


def test_a_bound_of_the_session_is_kept(spark, docs, unset):
    spark.conf.set(NAME, "1m")
    corpus_pipeline.encode(spark, docs(["a text"]), "")
    assert spark.conf.get(NAME) in ("1m", str(1 << 20))
