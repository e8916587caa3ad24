"""Effects of blocks on a number that is handed from one to the next.

A detector that carries one number through a series sees a block as a function of the
number it is given. Where that function is named by two numbers ``p`` and ``q``, and two
functions one after the other have the same form, blocks are summarised by ``p``, ``q``
and ``fresh``, what the block hands on where nothing is given. These go up the tree of
``operators/blocks.py``, and the numbers given come down.
"""

from collections.abc import Callable
from dataclasses import dataclass

import pyarrow as pa

from fieldwatch.operators.blocks import Place, filled, one_row

Pair = tuple[float, float]


@dataclass(frozen=True)
class Effects:
    """How effects of one kind are chained and applied.

    ``forgets`` makes the effect of a stretch in which a series begins: it hands on one
    number whatever it is given.
    """

    sql_type: str
    arrow_type: pa.DataType
    chain: Callable[[Pair, Pair], Pair]
    after: Callable[[Pair, float], float]
    forgets: Callable[[float], Pair]

    @property
    def schema(self) -> str:
        """Columns of a summary."""
        ends = "head_site string, head_pollutant string, head_at bigint, "
        kind = self.sql_type
        return f"block int, part int, {ends}{ends.replace('head', 'tail')}p {kind}, q {kind}, fresh {kind}"

    @property
    def columns(self) -> list[str]:
        return [field.split()[0] for field in self.schema.split(", ")]

    def row(self, unit: dict) -> pa.RecordBatch:
        kinds = {"block": pa.int32(), "part": pa.int32()}
        for end in ("head", "tail"):
            kinds |= {f"{end}_site": pa.string(), f"{end}_pollutant": pa.string(), f"{end}_at": pa.int64()}
        kinds |= dict.fromkeys(("p", "q", "fresh"), self.arrow_type)
        return one_row(**{name: (unit[name], kind) for name, kind in kinds.items()})

    def merge(self, gap: int | None):
        """One summary for each group of neighbouring ones."""

        def run(batches):
            whole = None
            for unit in _units(batches):
                if whole is None or whole["block"] != unit["group"]:
                    if whole:
                        yield self.row(whole)
                    whole = unit | {"block": unit["group"], "part": 0}
                    continue
                own = (unit["p"], unit["q"])
                if _goes_on(unit, whole, gap):
                    effect = self.chain((whole["p"], whole["q"]), own)
                    fresh = self.after(own, whole["fresh"])
                else:
                    effect, fresh = self.forgets(unit["fresh"]), unit["fresh"]
                whole |= {"p": effect[0], "q": effect[1], "fresh": fresh}
                whole |= {name: value for name, value in unit.items() if name.startswith("tail_")}
            if whole:
                yield self.row(whole)

        return run

    def fold(self, gap: int | None):
        """The number each unit is given; ``carry`` is the one given to its group."""

        def run(batches):
            blocks, numbers = [], []
            before, out = None, None
            for unit in _units(batches):
                if before is None or before["group"] != unit["group"]:
                    given = unit["carry"]
                else:
                    given = out if _goes_on(unit, before, gap) else None
                if given is not None:
                    blocks.append(unit["block"])
                    numbers.append(given)
                before = unit
                out = unit["fresh"] if given is None else self.after((unit["p"], unit["q"]), given)
            yield pa.RecordBatch.from_arrays(
                [pa.array(blocks, pa.int32()), pa.array(numbers, self.arrow_type)], names=["block", "carry"]
            )

        return run


def ends(end: str, place: Place) -> dict:
    """Where a summary begins or ends."""
    return {f"{end}_site": place.site_id, f"{end}_pollutant": place.pollutant_type, f"{end}_at": place.at}


def _goes_on(unit: dict, before: dict, gap: int | None) -> bool:
    """True when a unit begins in the series that the one before it ends in."""
    head = Place(unit["head_site"], unit["head_pollutant"], unit["head_at"])
    return head.continues(Place(before["tail_site"], before["tail_pollutant"], before["tail_at"]), gap)


def _units(batches):
    return (row for batch in filled(batches) for row in batch.to_pylist())
