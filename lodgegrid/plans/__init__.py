"""Compositions: warehouse build, datamart views and the registered queries."""
