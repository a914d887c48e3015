"""Causal root-cause analysis on Spark DataFrames.

Columns of a table are nodes of a known cause-and-effect graph. The package fits one mechanism per
node with distributed aggregates and answers causal questions as DataFrame queries.
"""

from tracecause.operators.graph import CausalGraph
from tracecause.operators.mechanisms import CausalModel, Mechanism, fit

__all__ = ["CausalGraph", "CausalModel", "Mechanism", "fit"]
