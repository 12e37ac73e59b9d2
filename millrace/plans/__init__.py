from millrace.plans.load import ensure_layers, load_batch, qualified, write_table

__all__ = ["ensure_layers", "load_batch", "qualified", "write_table"]
