"""Registered queries: importing the modules fills the registry."""

from featurekit.plans import (  # noqa: F401
    boosters,
    encoding,
    evaluation,
    exploration,
    grouping,
    history,
    numbered,
    rows,
    splitting,
    storage,
    training,
)
