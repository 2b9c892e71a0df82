"""Hosts whose pages are mostly copies of one page."""

from caremart.llm import html_text


def test_copies_of_a_page_are_no_template(spark):
    page = "<body><div class='top'>Always here</div><div class='z'>{}</div></body>"
    rows = [(k, f"http://a.example/?utm={k}", page.format("the copied text")) for k in range(38)]
    rows += [(100 + k, f"http://a.example/{k}", page.format(f"own text {k}")) for k in range(12)]
    rows += [(200 + k, f"http://b.example/{k}", page.format("the copied text")) for k in range(10)]
    got = {r["page_id"]: r["text"] for r in html_text.main_text(
        spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[k] == "the copied text" for k in range(38))
    assert all(got[100 + k] == f"own text {k}" for k in range(12))
    # One distinct page: nothing tells template from content.
    assert all(got[200 + k] == "Always here the copied text" for k in range(10))
