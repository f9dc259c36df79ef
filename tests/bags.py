"""Rows of a frame in a fixed order, for comparisons."""


def rows(frame, *order):
    """Rows as tuples, sorted by the given columns or by everything."""
    found = [tuple(r) for r in (frame.orderBy(*order) if order else frame).collect()]
    return found if order else sorted(found, key=repr)
