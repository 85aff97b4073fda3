"""What the tests of this folder share."""

SF = "/root/testdata/sf0.001"
# names that the operators use inside
CLASHING = ["d", "t", "line", "fp", "x", "node", "holder", "shard", "kind", "_t", "_k", "_row", "row", "n", "digest", "component", "low", "a", "b"]


def with_clashes(df):
    """More columns, with names that operators use inside."""
    from pyspark.sql import functions as F
    return df.select("*", *[F.lit(f"extra {c}").alias(c) for c in CLASHING if c not in df.columns])
