from tickwise.cli import main

raise SystemExit(main())
