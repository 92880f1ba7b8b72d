"""What test modules share. Not in a conftest: test folders each have one, and all are imported by that name."""


def rows(df, *order):
    """Collected rows as tuples, sorted by the given columns or by text."""
    got = [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]
    return got if order else sorted(got, key=repr)
