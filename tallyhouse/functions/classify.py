"""Dessert classifier for misspelt item names (P1, P2), as native expressions."""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F

# Product classes in report order.
PRODUCTS = (
    "Cake Red Velvet",
    "Cake Chocolate Temptation",
    "Cheesecake Pistachio",
    "Macarons French",
    "Cake Carrot",
    "Cake Cappuccino",
    "Cheesecake Dulce de Leche",
    "Cheesecake Strawberry",
    "Tiramisu With Ladyfingers",
    "Tiramisu",
    "Cheesecake Chocolate Ganache",
    "Cake Torta Nocciola",
    "Tart Mixed Berry",
    "Cake Ricotta and Pistachio",
    "Cake Chocolate Fondant",
    "Cake Tres Leches",
    "Cake Red Velvet Mini Gluten Free",
    "Cheesecake Brownie",
)

# Spellings seen in the feeds.
CHEESECAKE = (
    "cheesecake", "cheese cake", "chees cake", "chesscake", "chescake", "chssecake", "chz cake",
    "chez cake", "cheeze cake", "cheescake", "chesecake", "cheeaecake", "cheasecake",
    "cheesecakw", "che cake",
)
PISTACHIO = ("pistachio", "pistashio", "pistacio", "piatachio", "pitachio", "pstachio")
RICOTTA = ("ricotta", "ricota", "riotta", "icotta")
BROWNIE = ("brownie", "browni", "brawni", "brwni", ".brawni")
TIRAMISU = ("tiramisu", "taramisu", "tiramiso", "tirmisu")
RED_VELVET = ("red velvet", "re velvet", "red velt", "redvelvet", "rv cake")
STRAWBERRY = (
    "strawberry", "straberry", "strabery", "strwberry", "strabrry", "stwberry", "trawberry",
)
CARROT = ("carrot", "carot", "carott")
CAKE = ("cake", "cak")

# Exact feed-B names and their class.
EXACT_NAMES = {
    "torta nocciola": "Cake Torta Nocciola",
    "red velvet cake": "Cake Red Velvet",
    "mini gf red velvet cake": "Cake Red Velvet Mini Gluten Free",
    "mini gluten-free red velvet": "Cake Red Velvet Mini Gluten Free",
    "tres leches cake": "Cake Tres Leches",
    "chocolate ganache cheesecake": "Cheesecake Chocolate Ganache",
    "macarons french collection": "Macarons French",
    "french macarons": "Macarons French",
    "macaron": "Macarons French",
    "strawberry cheesecake": "Cheesecake Strawberry",
    "tiramisu individual": "Tiramisu",
    "tiramisu big ladyfinger": "Tiramisu With Ladyfingers",
    "tiramisu with ladyfingers": "Tiramisu With Ladyfingers",
    "mixed berry tart": "Tart Mixed Berry",
    "chocolate temptation cake": "Cake Chocolate Temptation",
    "cheesecake pistachio": "Cheesecake Pistachio",
    "pistachio cheesecake": "Cheesecake Pistachio",
    "cappuccino cake": "Cake Cappuccino",
    "carrot cake": "Cake Carrot",
    "dulce de leche cheesecake": "Cheesecake Dulce de Leche",
    "chocolate fondant cake": "Cake Chocolate Fondant",
    "cheesecake brownie": "Cheesecake Brownie",
    "brownie cheesecake": "Cheesecake Brownie",
    "ricotta & pistachio cake": "Cake Ricotta and Pistachio",
    "ricotta and pistachio cake": "Cake Ricotta and Pistachio",
}


@dataclass(frozen=True)
class Rung:
    """A class that needs one spelling of every group in ``need``, none of ``bar``."""

    product: str
    need: tuple[tuple[str, ...], ...]
    bar: tuple[str, ...] = ()
    tail: tuple[str, ...] = ()  # alternative to the last group: the text ends so

    def test(self, text: Column) -> Column:
        """One pattern per group keeps the expression small enough to compile."""
        patterns = ["|".join(map(re.escape, group)) for group in self.need]
        if self.tail:
            patterns[-1] += "|(" + "|".join(map(re.escape, self.tail)) + ")$"
        out = reduce(and_, [text.rlike(p) for p in patterns])
        return out & ~text.rlike("|".join(map(re.escape, self.bar))) if self.bar else out


# The first rung that holds decides.
LADDER = (
    Rung("Cake Red Velvet Mini Gluten Free", (("velvet", "revelvet"), ("mini", "gluten"))),
    Rung("Cake Red Velvet", (RED_VELVET,), bar=("mini", "cupcake", "cup cake")),
    Rung("Cake Chocolate Temptation", (("temptation",),)),
    Rung("Cake Ricotta and Pistachio", (RICOTTA, PISTACHIO + CAKE)),
    Rung("Cheesecake Pistachio", (PISTACHIO, CHEESECAKE), bar=RICOTTA),
    Rung("Macarons French", (("macaron",),)),
    Rung("Cake Carrot", (CARROT, CAKE)),
    Rung("Cake Cappuccino", (("cappuccino",), CAKE)),
    Rung("Cheesecake Dulce de Leche", (("dulce",), CHEESECAKE + ("leche",))),
    Rung("Cheesecake Strawberry", (STRAWBERRY + ("fragola",), CHEESECAKE)),
    Rung("Cheesecake Strawberry", (("2 strawberry",), ("cake",))),
    Rung("Tiramisu With Ladyfingers", (TIRAMISU, ("ladyfinger",))),
    Rung("Tiramisu", (TIRAMISU,), bar=("latte", "ladyfinger")),
    Rung("Cheesecake Chocolate Ganache", (("ganache",), CHEESECAKE)),
    Rung("Cheesecake Chocolate Ganache", (("choc gan",),)),
    Rung("Cake Torta Nocciola", (("nocciola",),)),
    Rung("Tart Mixed Berry", (("berry", "bery"), ("tart", "trt")), tail=("tar",)),
    Rung("Cake Chocolate Fondant", (("fondant",),)),
    Rung("Cake Tres Leches", (("tres leche", "tres lech"),)),
    Rung("Cheesecake Brownie", (BROWNIE, CHEESECAKE)),
)


def _plain(col: Column | str) -> Column:
    return F.lower(F.btrim(F.col(col) if isinstance(col, str) else col, F.lit(" \t\r\n")))


def classify_by_keyword(col: Column | str) -> Column:
    """Class of an item name, NULL where no rung holds."""
    text = _plain(col)
    start = F.when(F.lit(False), F.lit(None).cast("string"))
    return reduce(lambda acc, rung: acc.when(rung.test(text), F.lit(rung.product)), LADDER, start)


def classify_by_name(col: Column | str) -> Column:
    """Exact name first, keyword ladder otherwise."""
    pairs = [F.lit(part) for pair in EXACT_NAMES.items() for part in pair]
    known = F.try_element_at(F.create_map(*pairs), _plain(col))
    return F.coalesce(known, classify_by_keyword(col))
