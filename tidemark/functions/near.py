"""Boolean NEAR predicate over local text.

The remote search gives neither its distance nor its order nor its stemming. Ours: a term matches a word that starts with it, whatever its
case; NEAR holds if words for all its terms, in any order, have at most ``distance`` words between
neighbours. A clause with a hyphen is one literal term.
"""

from __future__ import annotations

import re
from itertools import permutations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: the standing query.
STANDING_QUERY = (
    "(digital NEAR replica) OR (computer-generated) OR (digital NEAR forger) OR (artificial NEAR intelligence) OR"
    " (automated NEAR decision NEAR making) OR (automatic NEAR decision NEAR making) OR (decision NEAR making NEAR tool) OR"
    " (automated NEAR decision NEAR tool) OR (automatic NEAR decision NEAR tool) OR (automated NEAR decision NEAR system) OR"
    " (automatic NEAR decision NEAR system) OR (automated NEAR final NEAR decision) OR (automatic NEAR final NEAR decision) OR"
    " (face NEAR recog) OR (facial NEAR recog) OR (voice NEAR recog) OR (iris NEAR recog) OR (gait NEAR recog) OR (genAI) OR (gen-AI) OR"
    " (generative NEAR AI) OR (generative NEAR tech) OR (generative NEAR model) OR (generative NEAR artificial) OR (machine NEAR learning) OR"
    " (deep NEAR learning) OR (chat NEAR bot) OR (virtual NEAR assistant) OR (ChatGPT) OR (Chat-GPT) OR (language NEAR model) OR"
    " (AI NEAR task NEAR force) OR (AI NEAR advis) OR (AI NEAR audit) OR (AI NEAR generate) OR (AI NEAR snoop) OR (deep NEAR fake) OR"
    " (synthetic NEAR media) OR (digital NEAR assistant) OR (natural NEAR language NEAR process) OR (computer NEAR vision) OR"
    " (frontier NEAR model) OR (software NEAR agent) OR (embodied NEAR robot) OR (foundation NEAR model) OR (LLM) OR (LLMs) OR"
    " (Information NEAR Technology NEAR Act)"
)


def parse_query(query: str) -> list[list[str]]:
    """OR of clauses, each the terms that must be near each other."""
    clauses = []
    for part in re.split(r"\s+OR\s+", query.strip()):
        terms = [t.strip() for t in re.split(r"\s+NEAR\s+", part.strip().strip("()").strip())]
        if all(terms):
            clauses.append(terms)
    return clauses


def clause_pattern(terms: list[str], distance: int = 10) -> str:
    """A regular expression without lookaround, so other engines take it as well."""
    orders = []
    for order in permutations(terms):
        orders.append((r"\w*(?:\W+\w+){0,%d}?\W+" % distance).join(re.escape(t).replace(r"\-", "-") for t in order))
    return r"(?i)\b(?:" + "|".join(orders) + ")"


def near(text: Column, query: str, distance: int = 10) -> Column:
    found = F.lit(False)
    for terms in parse_query(query):
        found = found | text.rlike(clause_pattern(terms, distance))
    return F.coalesce(found, F.lit(False))
