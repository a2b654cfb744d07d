from dimkeep.functions import dates, predicates, text

__all__ = ["dates", "predicates", "text"]
