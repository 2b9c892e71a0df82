"""Everything known about one person, or about a whole set of persons.

``who`` is a person id, which becomes a plain filter that reaches the scan, or
a DataFrame with a ``person_id`` column, which becomes a semi-join. No side is
forced to broadcast: its size is the caller's, so the planner decides from
statistics and, at run time, from the real size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Who = str | DataFrame


def rows_of(rows: DataFrame, who: Who, person: str) -> DataFrame:
    """Rows of a feed from which the persons' records are made.

    Ids do not tell an empty person from none, so neither does this: the rows
    may be more than the persons', never fewer.
    """
    told = F.coalesce(F.col(person), F.lit(""))
    if isinstance(who, str):
        return rows.filter(told == F.lit(who))
    persons = who.select(F.coalesce("person_id", F.lit("")).alias("_person")).distinct()
    return rows.join(persons, told == F.col("_person"), "left_semi")


def _of(table: DataFrame, who: Who) -> DataFrame:
    if isinstance(who, str):
        return table.filter(F.col("person_id") == F.lit(who))
    return table.join(who.select("person_id").distinct(), "person_id", "left_semi").select(
        *table.columns
    )


def review_person(person: DataFrame, who: Who) -> DataFrame:
    return _of(person, who)


def review_visits(visit: DataFrame, who: Who) -> DataFrame:
    return _of(visit, who)


def review_conditions(condition: DataFrame, who: Who) -> DataFrame:
    return _of(condition, who)


def review_procedures(procedure: DataFrame, who: Who) -> DataFrame:
    return _of(procedure, who)


def review_drugs(drug: DataFrame, who: Who) -> DataFrame:
    return _of(drug, who)


def review_providers(person: DataFrame, provider: DataFrame, who: Who) -> DataFrame:
    """Provider rows named in the persons' provider lists.

    ``providers`` is the list entry that matched; for a set of persons each
    row also says whose it is.
    """
    listed = _of(person, who).select(
        "person_id", F.explode(F.split("provider_id", ",")).alias("providers")
    )
    joined = provider.join(listed, provider["provider_id"] == listed["providers"], "inner")
    columns = [provider[c] for c in provider.columns] + [listed["providers"]]
    if not isinstance(who, str):
        columns.append(listed["person_id"])
    return joined.select(*columns)


def review_costs(cost: DataFrame, visit: DataFrame, drug: DataFrame, who: Who) -> DataFrame:
    """Cost rows of the persons' visits and drugs.

    The cost table refers to events of several kinds by one column; the domain
    says which. Event ids are made distinct before the join, so it never fans
    out, and both kinds go through a single join.
    """
    events = (
        _of(visit, who)
        .select("person_id", F.col("visit_occurrence_id").alias("event"), F.lit("visit").alias("domain"))
        .unionByName(
            _of(drug, who).select(
                "person_id", F.col("drug_exposure_id").alias("event"), F.lit("drug").alias("domain")
            )
        )
        .distinct()
    )
    joined = cost.join(
        events,
        (cost["cost_event_id"] == events["event"]) & (cost["cost_domain_id"] == events["domain"]),
        "inner",
    )
    columns = [cost[c] for c in cost.columns] + [events["event"].alias("visit_occurrence_id")]
    if not isinstance(who, str):
        columns.append(events["person_id"])
    return joined.select(*columns).distinct()
