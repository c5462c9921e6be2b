"""Physical-plan helpers: hot-key splitting, global ordering, stored intermediates."""
