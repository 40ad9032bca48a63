"""Long texts cut into parts: every window is in one fragment, whatever the size of the parts."""

import pyarrow as pa
import pytest

from ratesmith.llm import repeats
from tests.llm.test_repeats import LENGTH, corpus, plain


@pytest.mark.parametrize("chunk", [1000, 401, repeats.CHUNK_BYTES])
def test_every_window_in_one_fragment(monkeypatch, chunk):
    monkeypatch.setattr(repeats, "CHUNK_BYTES", chunk)
    texts = [text or "" for text in corpus()]
    data = [text.encode() for text in texts]
    assert max(map(len, data)) > 3 * 1000
    batch = pa.RecordBatch.from_arrays(
        [pa.array([b"%d" % i for i in range(len(texts))], pa.binary()), pa.array(texts)], names=["key", "text"])
    rows = [row for out in repeats._fragment_rows(iter([batch])) for row in out.to_pylist()]
    windows = sorted((int(r["key"]), at) for r in rows for at in range(r["low"], r["high"] + 1))
    assert windows == [(i, at) for i, d in enumerate(data) for at in range(len(d) - LENGTH + 1)]
    # windows with the same bytes are found under the same anchor
    anchors = {}
    for row in rows:
        own = data[int(row["key"])]
        for at in range(row["low"], row["high"] + 1):
            assert anchors.setdefault(own[at:at + LENGTH], row["anchor"]) == row["anchor"]
    repeated = {i for i, figures in enumerate(plain(texts)) if figures[1]}
    assert repeated and repeated <= {i for i, _ in windows}
