"""All lookup definitions of a payload as one flat array, in declaration order."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from weftline.config import Options
from weftline.functions import json_text as J
from weftline.functions.keys import signature
from weftline.operators.guards import MAX_LOOKUP_LEVELS

_BAG = J.BAG_DDL
NODE_DDL = (
    "array<struct<ord:string,parent:string,path:string,attribute:string,depth:int,absent:boolean,"
    f"entity:string,keys:{_BAG},`create`:boolean,create_attrs:{_BAG},eff_depth:int,sig:string,"
    "above:array<string>,nested:string,holder:string>>"
)


@lru_cache(maxsize=16)
def lookup_nodes(options: Options) -> Column:
    """Flatten the lookup tree in ``lookups``. ``ord`` sorts nodes as they were written, parents first.

    Depth budget and the signatures above a node are carried down, so the checks for
    depth and cycles need nothing but the node itself.
    """
    lookups, max_depth = F.col("lookups"), F.col("max_depth")
    budget = F.least(
        F.greatest(F.coalesce(max_depth, F.lit(options.max_lookup_depth)), F.lit(1)), F.lit(options.max_lookup_depth)
    )

    member = J.member

    def nodes(text: Column, parent: Column, path: Column, depth: Column, eff: Column, above: Column, holder: Column) -> Column:
        described = F.transform(
            F.map_entries(J.texts_by_name(text)),
            lambda e, i: F.struct(
                e["key"].alias("key"),
                i.alias("i"),
                e["value"].alias("m"),
                J.bag(member(e["value"], "keyattributes")).alias("keys"),
            ),
        )
        return F.coalesce(
            F.transform(
                described,
                lambda e: F.struct(
                    F.concat(parent, F.lit("."), F.lpad(e["i"].cast("string"), 7, "0")).alias("ord"),
                    parent.alias("parent"),
                    F.concat(path, F.lit("."), e["key"]).alias("path"),
                    e["key"].alias("attribute"),
                    depth.alias("depth"),
                    e["m"].isNull().alias("absent"),
                    member(e["m"], "entitylogicalname").alias("entity"),
                    e["keys"].alias("keys"),
                    F.coalesce(member(e["m"], "createifnotexists") == "true", F.lit(False)).alias("create"),
                    J.bag(member(e["m"], "createattributes")).alias("create_attrs"),
                    F.when(
                        member(e["m"], "maxdepth").isNotNull(),
                        F.least(
                            F.greatest(member(e["m"], "maxdepth").try_cast("int"), F.lit(1)),
                            F.lit(options.max_lookup_depth),
                        ),
                    )
                    .otherwise(eff)
                    .alias("eff_depth"),
                    signature(member(e["m"], "entitylogicalname"), e["keys"]).alias("sig"),
                    above.alias("above"),
                    member(e["m"], "nestedlookups").alias("nested"),
                    holder.alias("holder"),
                ),
            ),
            F.array(),
        ).cast(NODE_DDL)

    first = nodes(lookups, F.lit(""), F.lit("Lookups"), F.lit(0), budget, F.array().cast("array<string>"), F.lit(None).cast("string"))

    def next_level(levels: Column, level: Column) -> Column:
        last = F.element_at(levels, -1)
        below = F.flatten(
            F.transform(
                F.filter(last, lambda n: n["nested"].isNotNull()),
                lambda n: nodes(
                    n["nested"],
                    n["ord"],
                    n["path"],
                    n["depth"] + 1,
                    n["eff_depth"],
                    F.concat(n["above"], F.array(n["sig"])),
                    n["entity"],
                ),
            )
        )
        return F.when(F.size(last) == 0, levels).otherwise(F.concat(levels, F.array(below)))

    levels = F.aggregate(
        F.sequence(F.lit(2), F.lit(MAX_LOOKUP_LEVELS)),
        F.array(first).cast(f"array<{NODE_DDL}>"),
        next_level,
    )
    return F.when(
        lookups.isNotNull(), F.array_sort(F.flatten(levels), lambda a, b: F.when(a["ord"] < b["ord"], -1).otherwise(1))
    ).otherwise(F.array().cast(NODE_DDL))
