"""Agencies of users: right with overlapping and null groups, and put in order by group, not by user."""

from __future__ import annotations

from itertools import product

import pytest

from recordbridge.functions import dates
from recordbridge.plans import import_tables

PEOPLE = [(1, "A, B", "a", "g1"), (1, "A, B", "a", "g2"), (1, "A, B", "a", "g2"), (2, "C, D", "c", "g2"), (3, "E, F", "e", None), (None, "N, N", None, "g1"), (641, "Admin", "x", "g1"), (4, "G, H", "g", "g1")]
REACH = [(i, "g1") for i in range(12)] + [(i, "g2") for i in range(8, 30)] + [(i, None) for i in range(9)] + [(None, "g1")]
OWNERS = [(i, f"p{i % 20}", i % 11 or None, f"n{i % 11}") for i in range(30)] + [(3, "other", 3, "n3"), (5, "p5", 5, "n5")]


def tables(make):
    return (
        make("UserID long, UserName string, UserEmail string, EDAGroupName string", *PEOPLE), make("ProjectID long, EDAGroup string", *REACH),
        make("ProjectID long, ProjectName string, AgencyID long, AgencyName string", *OWNERS),
    )


def expected(dedupe):
    reached = {(*u, name, agency, called) for (*u, group), (project, of), (own, name, agency, called) in product(PEOPLE, REACH, OWNERS)
               if u[0] != 641 and group == of and project == own and project is not None and agency is not None}
    found = {}
    for *user, _, agency, _ in reached:
        found.setdefault(tuple(user), []).append(agency)
    return {user: sorted(set(a) if dedupe else a) for user, a in found.items()}


@pytest.mark.parametrize("dedupe", [False, True])
def test_agencies_of_users_against_brute_force(make, rows, dedupe):
    given, wanted = tables(make), expected(dedupe)
    beyond = [(*user, agency, place) for user, own in wanted.items() for place, agency in enumerate(own, 1) if place > 8]
    assert beyond and rows(import_tables.users_over_limit(*given, dedupe=dedupe)) == sorted(beyond, key=repr)
    table = import_tables.users(*given, dates.day("2020-01-01"), dedupe=dedupe)
    got = rows(table.select("email", "user_agencies__ref_agency", *[f"user_agencies{i}" for i in range(2, 9)]))
    assert got == sorted([(user[2], own[0], *[*map(str, own[1:8]), *[""] * (8 - len(own[:8]))]) for user, own in wanted.items()], key=repr)


def test_rows_beyond_a_limit_are_ordered_by_group(make):
    """Not a row for every user and project is sorted, but one for every set of groups and project."""
    plan = import_tables.users_over_limit(*tables(make))._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert windows and not any("UserID" in line for line in windows)


def test_users_meet_the_first_agencies_only(make):
    plan = import_tables.users(*tables(make), dates.day("2020-01-01"))._jdf.queryExecution().optimizedPlan().toString()
    assert any("Window [" in line and "EDAGroup" in line for line in plan.splitlines())
