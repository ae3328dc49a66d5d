"""A stand-in for a Python model, for queries and tests."""

from __future__ import annotations

from reviewlens.operators.models import Scorer, ScorerFactory
from reviewlens.schema import V2_RULES, RuleSpec


def lexicon_scorer(spec: RuleSpec = V2_RULES) -> ScorerFactory:
    """A stand-in model over texts: more positive than negative words, fewer, or neither."""

    def factory() -> Scorer:
        def score(texts: list[str]):
            verdicts = []
            for text in texts:
                low = text.lower()
                lean = sum(w in low for w in spec.positive_words) - sum(w in low for w in spec.negative_words)
                verdicts.append(spec.positive if lean > 0 else spec.negative if lean < 0 else spec.neutral)
            return [v.label_id for v in verdicts], [list(v.proba) for v in verdicts]

        return score

    return factory
