"""File readers, the dated lake, the feature store and the table bindings."""
