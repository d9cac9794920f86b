"""Operators for preparing language-model training data, and the queries that run them.

Nothing else in the library imports this subpackage. Each module holds one operator:

``edit_embedding``   document fingerprints by a randomised edit embedding
``transcripts``      transcript parsing by a hidden Markov model
``set_join``         n-gram Jaccard join with PartEnum signatures
``histogram_sort``   sharding by histogram sort
``url_tree``         URL filter over a path-template tree
``rule_ensemble``    quality classifier, a sparse ensemble of rules
``mixing``           mixing sources to target weights by hash thresholds
``language_spans``   language identification by Viterbi over words
``templates``        benchmark decontamination by canonical templates
``personal_data``    personal data by patterns and a conditional random field
``term_scan``        ranked lexical search by an Aho-Corasick scan
``ring_simhash``     SimHash near-duplicates by pigeonring filtering
``merkle_manifest``  Merkle manifest by checkpoint and recompute

``queries`` binds them to the given tables.
"""
