import hashlib
import re

from quillmark.llm import warc
from quillmark.llm.common import read
from tests import comparing


def test_same_as_sql(spark, sf):
    rows = warc.op2_warc(spark, sf)
    con = comparing.connect(sf)
    answer = con.execute(warc.ORACLE)
    names = [c[0] for c in answer.description]
    assert sorted(names) == sorted(rows.columns)
    assert sorted(map(tuple, rows.select(*names).collect())) == sorted(answer.fetchall())


def test_records_are_linked_and_whole(spark):
    pages = spark.createDataFrame(
        [(1, "http://a", "<p>A &lt;b&gt; &amp;amp;</p><script>x</script><p>é</p>", 1), (2, None, None, 1), (2, None, None, 1)],
        "page_id bigint, url string, html string, block int",
    )
    sources = {r.page_id: r for r in warc.responses(pages).collect()}
    rows = warc.derive(warc.responses(pages)).collect()
    assert len(rows) == 6
    for r in rows:
        source = sources[r.page_id]
        head, _, rest = r.record.partition("\r\n\r\n")
        fields = dict(line.split(": ", 1) for line in head.split("\r\n")[1:])
        assert fields["WARC-Refers-To"] == r.refers_to == source.record_id
        assert rest == r.block + "\r\n\r\n"
        assert int(fields["Content-Length"]) == len(r.block.encode()) == r.content_length
        assert r.block_digest == "sha256:" + hashlib.sha256(r.block.encode()).hexdigest()
        assert r.source_digest == "sha256:" + hashlib.sha256(source.payload.encode()).hexdigest()
        assert re.fullmatch("<urn:uuid:[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}>", r.record_id)
    texts = {(r.page_id, r.record_type): r.block for r in rows}
    assert texts[1, "conversion"] == "A <b> &amp;\né" and texts[2, "conversion"] == ""
    assert "source-header: Content-Type: text/html; charset=utf-8\r\n" in texts[1, "metadata"]
    assert warc.derive(warc.responses(pages.where("page_id > 9"))).count() == 0
