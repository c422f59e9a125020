"""phrasegrove: grouping short texts by meaning, as Spark jobs.

Phrases without a vector are embedded inside the executors, a three-level cluster
hierarchy is learned from the vectors, every new phrase is mapped to its cluster,
parent and grandparent, and clusters are named from their most central phrases.
"""

from phrasegrove.params import ClusterParams, EmbedParams, NamingParams, Tables

__all__ = ["ClusterParams", "EmbedParams", "NamingParams", "Tables"]
