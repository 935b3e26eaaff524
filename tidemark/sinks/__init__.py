"""Writers of feeds, exports, catalogues, lineage and layers."""
