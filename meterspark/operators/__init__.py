"""DataFrame-to-DataFrame operators. None runs an action; all take their clock as an argument."""
