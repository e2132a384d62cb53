"""What a Python worker holds between its tasks."""

import weakref
from types import SimpleNamespace

import public_tokenizers
import pytest
from pyspark import TaskContext, cloudpickle

from pulsetide.llm import align, packing, queries, tokens, words as w

BYTE_LEVEL, PIECES, WORDS = (public_tokenizers.path(p) for p in (queries.BYTE_LEVEL, queries.PIECES, queries.VOCABULARY))


@pytest.fixture
def sent(spark, monkeypatch):
    """The functions given to mapInArrow, as tasks get them."""
    made = []
    kind = type(spark.range(0))
    ours = kind.mapInArrow
    monkeypatch.setattr(kind, "mapInArrow", lambda self, f, *a, **b: made.append(cloudpickle.dumps(f)) or ours(self, f, *a, **b))
    monkeypatch.setattr(TaskContext, "get", lambda: SimpleNamespace(partitionId=lambda: 9))
    return lambda at: cloudpickle.loads(made[at])


@pytest.mark.parametrize(
    "operator, tool",
    [
        (lambda docs, folder: tokens.write_tokens(docs, WORDS, folder), lambda: tokens.encoder(WORDS)),
        (lambda docs, folder: packing.encoded(docs, BYTE_LEVEL, folder, 2048), lambda: packing.encoder(BYTE_LEVEL)),
        (lambda docs, folder: align.aligned(docs, BYTE_LEVEL, PIECES, folder), lambda: align.aligner(BYTE_LEVEL, PIECES)),
    ],
)
def test_tasks_of_a_worker_share_their_tokenizer(spark, tmp_path, sent, operator, tool):
    """a task dropped what the worker's tasks before it had made, and made it again."""
    operator(spark.createDataFrame([(1, "a b")], "doc_id long, text string"), str(tmp_path))
    own = tool()
    list(sent(0)(iter([])))
    assert tool() is own


def test_what_is_dropped_is_freed():
    """tokenizers that refer to themselves stayed until Python happened to collect them."""
    own = tokens.encoder(WORDS)
    gone = weakref.ref(own)
    del own
    w.keep_only()
    assert gone() is None
