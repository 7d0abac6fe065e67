"""Logical inputs: specs, edge conversion, loaders and test-table adapters."""

from pitwise.sources.inputs import Inputs
from pitwise.sources.schemas import SPECS, Spec, conform

__all__ = ["Inputs", "SPECS", "Spec", "conform"]
