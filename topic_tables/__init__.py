"""topic_tables: PLSA and Robust PLSA topic models as Spark DataFrame jobs."""

from topic_tables.operators.em import TopicModel, initial_phi, run_em  # noqa: F401
from topic_tables.operators.plsa import fit_plsa, fold_in  # noqa: F401
from topic_tables.operators.priors import Prior, SymmetricDirichlet, Uniform  # noqa: F401
from topic_tables.operators.robust import fit_robust_plsa, robust_fold_in  # noqa: F401
from topic_tables.operators.vocab import (  # noqa: F401
    Vocabulary, build_corpus, build_vocab, corpus_stats, index_tokens, prune, to_bags, token_counts,
)
from topic_tables.sources.tables import tokens_from_text  # noqa: F401
