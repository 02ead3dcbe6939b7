"""Driver contract: registered queries over the driver tables, each beside its SQL counterpart."""
