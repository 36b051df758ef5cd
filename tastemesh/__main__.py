from tastemesh.jobs import main

main()
