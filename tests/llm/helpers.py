"""Shared by the tests of this folder."""

NO_ID = -(1 << 63)


def ordered(docs):
    """Distinct documents in order, a missing doc_id first, a missing text as empty."""
    return sorted({((NO_ID if i is None else i), t or "") for i, t in docs})


def by_id(df, *columns):
    return {NO_ID if r["doc_id"] is None else r["doc_id"]: tuple(r[c] for c in columns)
            for r in df.collect()}
