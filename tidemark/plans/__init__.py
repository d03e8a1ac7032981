from tidemark.plans.daily_run import new_state, read_state, run_all, store_run

__all__ = ["new_state", "read_state", "run_all", "store_run"]
