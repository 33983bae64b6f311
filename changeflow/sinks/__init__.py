"""Writers: state snapshots, dead letters, audit history, seeding."""
