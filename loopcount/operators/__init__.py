"""DataFrame → DataFrame operators. None of them runs an action except ``broadcast.measured``."""
