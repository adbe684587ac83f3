"""visitlens: web-visit session analytics on Spark DataFrames.

Actions are grouped into sessions, joined with their users, filtered by the
parameters of an analysis task and summarised as duration / step-count
ratios. See README.md for the module map.
"""

__version__ = "0.1.0"
