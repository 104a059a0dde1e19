"""Where subscriptions, landed snapshots and gazetteers come from."""
