"""Folders of the test tables and a helper, under a module name that no other test folder has."""

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


def rows(df, *cols):
    """Collected rows as tuples (optionally only some columns), sorted."""
    if cols:
        df = df.select(*cols)
    return sorted(tuple(r) for r in df.collect())
