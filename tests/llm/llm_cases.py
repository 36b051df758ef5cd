"""Helpers of the tests here."""


def pairs(df):
    """(doc_id, text) of all rows, nulls as empty texts."""
    return [(r.doc_id, r.text or "") for r in df.select("doc_id", "text").collect()]
