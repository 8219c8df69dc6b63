from .tables import SchemaMismatch, ensure_table, merge_into, overwrite, with_part

__all__ = ["SchemaMismatch", "ensure_table", "merge_into", "overwrite", "with_part"]
