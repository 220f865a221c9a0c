"""The containment index as a stored table that follows the state of resources."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadloom.operators import resources
from quadloom.operators.keyed import picked
from quadloom.session import written
from quadloom.sources.store import BucketStore, Parts

CONTAINED = "container STRING, identifier STRING, interactionModel STRING"


def containment_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """What happens to ``resources.children`` between two states: their rows with ``sign`` -1 (gone) or 1 (new).

    One grouping of narrow rows: a row that both states have cancels out.
    """
    signed = [resources.children(df).withColumn("sign", F.lit(s)) for df, s in ((before, -1), (after, 1))]
    net = signed[0].unionByName(signed[1]).groupBy("container", "identifier", "interactionModel").agg(F.sum("sign").alias("sign"))
    return net.filter("sign <> 0")


class ContainmentView:
    """Children by container, kept beside a store of resources.

    ``refresh`` brings the view from the state it was made from, whose version
    its manifest holds, to the newest one: only buckets that were written
    between the two are read, and only buckets of containers that gained or
    lost a child, or whose child changed its model, are written. A refresh that
    fails, or that never ran, is made up for by the next one.
    """

    def __init__(self, state: BucketStore, root: str, buckets: int | None = None):
        self.state = state
        self.store = BucketStore(state.spark, root, CONTAINED, buckets or state.buckets, key="container", order=["identifier"])

    def refresh(self) -> DataFrame:
        """The changes that were applied."""
        base, now = self.store.source(), self.state.version()
        buckets = self.state.differing(base, now) if base else None
        after = self.state.read(now, buckets)
        before = self.state.read(base, buckets) if base else after.filter("false")
        # read more than once below
        changes = written(containment_changes(before, after), "changes")
        if base != now:
            by = ["container", "identifier", "interactionModel"]
            new = changes.filter("sign > 0").select(*by)

            gone = picked(changes.filter("sign < 0").select(*by), "gone")

            def apply(rows: DataFrame) -> Parts:
                far, near = gone.apart(rows, by)
                keys = gone.hinted()
                # by narrow keys of one row each, so no hot container is one task
                left = near.join(keys, [near[c].eqNullSafe(keys[c]) for c in by], "left_anti")
                return (left, new) if gone.small else (far, left.unionByName(new))

            self.store.change(changes.select("container"), apply, source=now)
        return changes

    def read(self) -> DataFrame:
        return self.store.read()
