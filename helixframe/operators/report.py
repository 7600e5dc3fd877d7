"""The report before an import: conflicting definitions, inferred definitions, malformed lines; tab-separated text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.operators.header import Header


def conflicts(definitions: DataFrame) -> DataFrame:
    """Of `header.definitions`, the fields that are defined in more than one way."""
    many = definitions.groupBy("category", "id").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    return definitions.join(many, ["category", "id"], "left_semi")


def _means(header: Header | None, category: str, ident: str) -> str:
    x = header.sections[category].get(ident) if header else None
    return f"num={x['Number']} type={x['Type']}" if x else "Not resolved."


def lines(definitions: DataFrame, resolved: Header | None = None, inferred: DataFrame | None = None, malformed: DataFrame | None = None) -> list[str]:
    """Definitions are as many as header fields, which are few. Malformed lines are of unknown number, so they are not
    collected: `malformed_lines` makes them a DataFrame to write beside this."""
    out, last = [], None
    for r in conflicts(definitions).orderBy("category", "id", "number", "type").toLocalIterator():
        new = (r.category, r.id) != last
        for i, f in enumerate(r.files):
            head = [r.id, r.category] if new and i == 0 else [" ", " "]
            out.append("\t".join([*head, f"num={r.number} type={r.type}" if i == 0 else " ", f, _means(resolved, r.category, r.id) if new and i == 0 else " "]))
        last = (r.category, r.id)
    out = ["Header Conflicts", "ID\tCategory\tConflicts\tFile Paths\tProposed Resolution", *out] if out else ["No Header Conflicts Found."]
    if inferred is not None:
        rows = [f"{r.id}\t{r.category}\tnum={r.number} type={r.type}" for r in inferred.orderBy("category", "id").toLocalIterator()]
        out += ["", "Inferred Headers", "ID\tCategory\tProposed Resolution", *rows] if rows else ["", "No Inferred Headers Found."]
    if malformed is not None and not malformed.head(1):
        out += ["", "No Malformed Records Found."]
    return out


def malformed_lines(malformed: DataFrame) -> DataFrame:
    return malformed.select(F.concat_ws("\t", F.coalesce("file", F.lit("")), F.translate("line", "\t", " "), "reason").alias("value")).orderBy("value")
