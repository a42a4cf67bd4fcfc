
import pytest

from hourlake.llm import pii
from hourlake.llm.common import share_package


@pytest.mark.parametrize("more", [0, 120])
def test_long_spans(spark, more):
    share_package(spark)
    mail = "zebra" + "1" * 600 + ".quagga%okapi@" + "x" * 30 + ".org"
    text = mail + " gnu" + "".join(f" 10.0.{i}.1" for i in range(more))
    # two texts, as copies of one are no evidence
    docs = spark.createDataFrame([(1, text), (2, text + "."), (3, "gnat"), (4, "x")], "doc_id long, text string")
    got = {r.doc_id: r for r in pii.find_personal(docs).collect()}
    assert len(got[1].base) == 1 + more
    assert [text[s.start:s.end] for s in got[1].terms] == ["gnu"] == [text[s.start:s.end] for s in got[2].terms]
