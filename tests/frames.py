"""Results of tests as plain Python values."""


def rows(df, *columns):
    """Rows as sorted plain tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()),
                  key=lambda r: tuple((v is not None, str(v)) for v in r))


def by_key(df, key, *columns):
    return {r[key]: tuple(r[c] for c in columns) if len(columns) > 1 else r[columns[0]]
            for r in df.collect()}
