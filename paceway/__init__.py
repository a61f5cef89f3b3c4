"""Travel-cost surfaces as Spark DataFrames."""

from paceway.meta import LayerMeta, layout_for_zoom

__all__ = ["LayerMeta", "layout_for_zoom"]
