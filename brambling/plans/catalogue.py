"""All queries outside the llm subpackage, by name."""

from brambling.plans import landscape, oracles, problems

QUERIES = {**problems.QUERIES, **landscape.QUERIES}
ORACLES = {**problems.ORACLES, **oracles.ORACLES}
