"""Whole queries composed of the operators, and the catalogue that names them."""

from finloom.plans import articles, graph, knowledge, mapped, mappers, market, news, pages, ranges, resolution, rules, runs, sessions, store  # noqa: F401  they register their queries
