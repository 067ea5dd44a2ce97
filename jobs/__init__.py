"""Jobs: tasks with a command line, a small config file and outputs that reruns leave the same."""
